"""Exact top-k by integer inner product as a Voronoi kNN join.

With one more coordinate, sqrt(M - |x|^2) for rows and 0 for queries, where M is the largest
squared norm, the largest inner products are the smallest Euclidean distances. Pivots cut
queries and rows into cells. From cell summaries alone (row counts by distance to the
pivot, query radii) an upper bound of the k-th distance of every query cell follows, and a block of rows
goes only to query blocks that its least possible distance does not rule out. Each pair of blocks
is solved locally; partial top lists are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.shared import written

PIVOTS = 48
SLACK = 1e-6  # relative, for rounding in bounds
PARTIAL = "query_id long, vec_id long, score long"


def scaled(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, x): floor(scale * component) of vectors without null or non-finite components."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.col("embedding").isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    return embeddings.filter(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("x"),
    )


def top_inner_products(
    embeddings: DataFrame,
    is_query: Column,
    *,
    k: int = 20,
    scale: int = 64,
    block_rows: int = 2048,
    query_rows: int = 512,
) -> DataFrame:
    """For each query its ``k`` best rows: query_id, rank from 1, vec_id, score.

    All rows but those with the query's own id are candidates; ties go to the smaller vec_id;
    fewer candidates give fewer rows. Vectors that are null or hold null or non-finite components
    take no part, nor do rows without an id. Vectors of another length than the query's do not meet it.
    Repeated rows and ids count each, as in a plain join: a row that is there twice takes two ranks,
    and a query that is there twice meets every row twice. Other columns are ignored.
    """
    vectors = written(scaled(embeddings, scale).filter("vec_id is not null"))
    squares = F.aggregate("x", F.lit(0.0), lambda a, c: a + c * c)
    top = vectors.groupBy(F.size("x").alias("d")).agg(F.max(squares).alias("m"))
    norms = {r.d: r.m for r in top.collect()}
    if not norms:
        return _ranked(vectors.sparkSession.createDataFrame([], PARTIAL), k)
    parts = [
        _one_length(vectors.filter(F.size("x") == d), m, is_query, k, block_rows, query_rows)
        for d, m in norms.items()
        if d > 0
    ]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of each query's partial lists, repeats among them."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _one_length(
    vectors: DataFrame, m: float, is_query: Column, k: int, block_rows: int, query_rows: int
) -> DataFrame:
    spark = vectors.sparkSession
    pivots = np.array(
        [r.x for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()]
    )
    tails = np.sqrt(np.maximum(0.0, m - (pivots**2).sum(1)))
    pivots = np.concatenate((pivots, tails[:, None]), 1)
    shared = spark.sparkContext.broadcast(pivots)

    def place(as_query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = shared.value
            for batch in batches:
                x = _matrix(batch.column(1))
                tail = np.zeros(len(x)) if as_query else np.sqrt(np.maximum(0.0, m - (x**2).sum(1)))
                y = np.concatenate((x, tail[:, None]), 1)
                square = (y**2).sum(1)[:, None] - 2 * y @ p.T + (p**2).sum(1)[None]
                cell = square.argmin(1)
                far = np.sqrt(((y - p[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(far)],
                    names=["vec_id", "x", "cell", "far"],
                )

        return run

    schema = "vec_id long, x array<double>, cell int, far double"
    rows = written(vectors.mapInArrow(place(False), schema))
    queries = written(vectors.filter(is_query).mapInArrow(place(True), schema))

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        """Blocks of about ``size`` rows of a cell with near equal distance to its pivot."""
        counts = df.groupBy("cell").agg(
            F.count("*").alias("n"), F.percentile_approx("far", [x / 16 for x in range(1, 16)], 1000).alias("cuts")
        )
        band = F.size(F.filter("cuts", lambda c: c < F.col("far")))
        salt = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / (16 * size)))
        return (
            df.join(counts, "cell")
            .withColumn("part", F.when(F.col("n") > size, F.concat_ws("-", band, salt)).otherwise("0"))
            .groupBy("cell", "part")
            .agg(
                F.min("far").alias("low"),
                F.max("far").alias("high"),
                F.count("*").alias("n"),
                F.collect_list(F.struct("vec_id", "x")).alias("rows"),
            )
            .withColumn(name, F.concat_ws("/", "cell", "part"))
        )

    row_blocks, query_blocks = written(blocks(rows, block_rows, "block")), written(blocks(queries, query_rows, "group"))
    # the cells of smallest greatest distance that hold k rows bound the k-th distance of a query cell
    summary = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    near = {r.cell: (r.n, r.far) for r in summary}
    own = rows.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    distance = np.sqrt(np.maximum(0, ((pivots[:, None] - pivots[None]) ** 2).sum(2)))
    bounds = []
    for q in range(len(pivots)):
        # fill k rows and as many as an id has (they may be the query's own) from the cells of smallest
        # greatest distance
        left, bound = k + own, float("inf")
        for reach, n in sorted((distance[q, c] + far, n) for c, (n, far) in near.items()):
            left -= n
            if left <= 0:
                bound = reach
                break
        bounds.append(bound)
    pairs = spark.createDataFrame(
        [
            (int(q), int(c), float(distance[q, c]), float(bounds[q]))
            for q in range(len(pivots))
            for c in near
        ],
        "q int, c int, apart double, bound double",
    )
    # every query of a group is within high of its pivot: no row of the block is nearer than
    # apart - high - block high, or than block low - apart - high
    g = query_blocks.select("group", F.col("cell").alias("q"), F.col("high").alias("radius"))
    b = row_blocks.select("block", F.col("cell").alias("c"), "low", F.col("high").alias("reach"))
    least = F.greatest(
        F.col("apart") - F.col("radius") - F.col("reach"), F.col("low") - F.col("apart") - F.col("radius"), F.lit(0.0)
    )
    most = F.col("bound") + F.col("radius")
    wanted = (
        g.join(pairs, "q").join(b, "c").filter(least * (1 - SLACK) <= most * (1 + SLACK)).select("group", "block")
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _solved(batch.column(0)[i].values, batch.column(1)[i].values, k)

    return (
        wanted.join(query_blocks.select("group", F.col("rows").alias("queries")), "group")
        .join(row_blocks.select("block", "rows"), "block")
        .select("queries", "rows")
        .mapInArrow(solve, PARTIAL)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _solved(queries: pa.StructArray, rows: pa.StructArray, k: int) -> pa.RecordBatch:
    """The k best rows of a block for each query of a block, exact in 64-bit integers."""
    qid, rid = queries.field("vec_id").to_numpy(), rows.field("vec_id").to_numpy()
    q, x = _matrix(queries.field("x")), _matrix(rows.field("x"))
    order = np.argsort(rid, kind="stable")
    rid, x = rid[order], x[order]
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2**53:
        score = (q @ x.T).astype(np.int64)
    else:
        score = np.stack([[int(s) for s in (a.astype(object) * x.astype(object)).sum(1)] for a in q])
    out: list[list[np.ndarray]] = [[], [], []]
    for i, own in enumerate(qid):
        other = np.flatnonzero(rid != own)
        s = score[i, other]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            pick = np.flatnonzero(s >= least)
            pick = pick[np.argsort(-s[pick], kind="stable")][:k]  # ids rise, so ties keep their order
        else:
            pick = np.arange(len(s))
        out[0].append(np.full(len(pick), own))
        out[1].append(rid[other[pick]])
        out[2].append(s[pick])
    columns = [np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in out]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])
