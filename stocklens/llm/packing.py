"""Variable-capacity best-fit packing of documents into training sequences.

Pieces are dealt by hash into shards of about ``shard_pieces``, and each shard is packed in one
task: pieces by falling length, each into the open bin with the least space that takes it.
Where none does, the permitted lengths are compared jointly: each is filled in thought
with the largest pieces still waiting, and the one of least cost per token held is opened.
At the end each bin is cut down to the cheapest permitted length that holds its contents. The
only loss against one global packing are the last few bins of each shard.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(text):
    """Words of a text column, runs of characters other than space and \\t to \\r."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def pack(
    documents: DataFrame,
    *,
    capacities: Sequence[int] = (512, 1024, 2048, 4096),
    cost: Callable[[int], float] = lambda capacity: capacity + 16.0,
    length=None,
    shard_pieces: int = 4096,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_id, capacity, bin_offset, bin_fill.

    ``length`` is a column expression over ``documents``, by default the number of words of the
    text. A document longer than the largest capacity is cut into pieces of that
    capacity and a rest; start counts from 0 in the document. Null, empty and
    word-free documents have length 0 and give one piece of length 0, in a bin like any other.
    Repeated and null ids are packed row by row. bin_id is the shard and a number within it.
    """
    sizes = sorted({int(c) for c in capacities})
    costs = {c: float(cost(c)) for c in sizes}
    top = sizes[-1]
    measured = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(word_count(F.col(text_column)) if length is None else length, F.lit(0))
        .cast("long")
        .alias("words"),
    )
    last = F.greatest(F.floor((F.col("words") - 1) / top), F.lit(0)).cast("long")
    pieces = measured.select(
        "doc_id", "words", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * top).alias("start"),
        F.least(F.col("words") - F.col("piece") * top, F.lit(top)).cast("int").alias("length"),
    )
    total = measured.agg(F.sum(last + 1)).first()[0] or 1
    shards = -(-total // shard_pieces)
    # ids alone would put repeated rows into one shard; they are few enough otherwise
    shard = F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(shards))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True])
        bins, at, fills, caps = assign(rows["length"].tolist(), sizes, costs)
        rows = rows.drop(columns="shard")
        rows["bin_id"] = [f"{key[0]}-{b}" for b in bins]
        rows["capacity"] = [caps[b] for b in bins]
        rows["bin_offset"] = at
        rows["bin_fill"] = [fills[b] for b in bins]
        return rows

    return (
        pieces.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(
            run,
            "doc_id long, piece long, start long, length int, bin_id string, capacity int,"
            " bin_offset int, bin_fill int",
        )
    )


def assign(
    lengths: list[int], sizes: Sequence[int], costs: dict[int, float]
) -> tuple[list[int], list[int], list[int], list[int]]:
    """Bin and offset of each length (given in falling order), then fill and capacity of each bin."""
    waiting: dict[int, int] = {}
    for n in lengths:
        waiting[n] = waiting.get(n, 0) + 1
    distinct = sorted(waiting)
    open_bins: dict[int, list[int]] = {}  # by space left
    spaces = 0  # bit s is set where a bin with s left is open
    bins, at, fills, room = [], [], [], []
    for n in lengths:
        waiting[n] -= 1
        fitting = spaces >> n
        if fitting:
            left = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                spaces &= ~(1 << left)
        else:
            b, left = len(fills), _least_cost(n, sizes, costs, distinct, waiting)
            fills.append(0)
            room.append(left)
        bins.append(b)
        at.append(fills[b])
        fills[b] += n
        left -= n
        open_bins.setdefault(left, []).append(b)
        spaces |= 1 << left
    caps = [min((c for c in sizes if c >= f), key=lambda c: (costs[c], c)) for f in fills]
    return bins, at, fills, caps


def _least_cost(
    n: int, sizes: Sequence[int], costs: dict[int, float], distinct: list[int], waiting: dict[int, int]
) -> int:
    best, chosen = None, sizes[-1]
    for c in (c for c in sizes if c >= n):
        left = c - n
        k = bisect_right(distinct, left) - 1
        while left > 0 and k >= 0 and distinct[k] > 0:
            take = min(waiting[distinct[k]], left // distinct[k])
            left -= take * distinct[k]
            k = min(k - 1, bisect_right(distinct, left) - 1)
        price = (costs[c] / max(c - left, 1), -c)
        if best is None or price < best:
            best, chosen = price, c
    return chosen
