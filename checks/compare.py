"""Compare registered queries with their SQL: ``python -m checks.compare [dir] [name ...]``."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(directory, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v else "0"
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, directory: str, query, sql: str) -> str:
    """'' when both sides agree, else what differs."""
    df = query(spark, directory)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if mine != theirs:
        a, b = list((mine - theirs).items()), list((theirs - mine).items())
        return (
            f"{sum(mine.values())} vs {sum(theirs.values())} rows, {len(a)}/{len(b)} differ\n"
            f"  columns {sorted(columns)}\n  spark {str(a[:2])[:700]}\n  sql   {str(b[:2])[:700]}"
        )
    return ""


def main(argv: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from checks.session import local_session

    directory = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, bad = local_session(), connect(directory), 0
    for name in names:
        start = time.time()
        try:
            said = compare(spark, con, directory, QUERIES[name], ORACLE[name])
        except Exception as e:  # noqa: BLE001 - report and go on
            said = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(said)
        print(f"{'DIFF' if said else 'ok  '} {name} {time.time() - start:.1f}s {said}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
