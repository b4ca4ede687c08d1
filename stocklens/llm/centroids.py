"""Centroid clustering whose nearest-centroid search is the threshold algorithm.

Each round assigns every vector to its nearest centroid and replaces every centroid by the
mean of its vectors. The centroids are few (``clusters`` x width numbers), so they travel
to the tasks inside the function; the vectors never leave their partitions. New centroids
are 64 column sums per cluster, combined on the map side: one row per cluster and
partition is shuffled, whatever the number of vectors or the size of the largest cluster.

Nearest centroid by the threshold algorithm: for every dimension the centroid values are
sorted once; a vector walks outward from its own value in every sorted list at once, one
step per round, and computes the exact distance of each centroid the first time any list
shows it. A centroid that no list has shown yet is at least as far as the sum of the
squared gaps at the frontiers, so the walk stops as soon as that sum is strictly above the
best exact distance found: the nearest centroid, ties to the smaller number, is then known.
Vectors of a batch walk together in numpy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def integer_vectors(vectors: DataFrame, width: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, x) of the vectors with exactly ``width`` finite components, x = floor(scale * c)."""
    c = F.col("embedding")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return vectors.filter(c.isNotNull() & (F.size(c) == width) & finite).select(
        "vec_id", F.transform(c, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("x")
    )


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number) and squared distance of every row, by the threshold algorithm.

    Returns the numbers, the distances and how many exact distances were computed.
    """
    n, width = values.shape
    k = len(centroids)
    if n == 0 or k == 0:
        return np.full(n, -1, np.int64), np.zeros(n, np.int64), 0
    order = np.argsort(centroids, axis=0, kind="stable").T            # width x k centroid numbers
    ranked = np.take_along_axis(centroids.T, order, axis=1)            # width x k sorted values
    dims = np.arange(width)
    right = np.stack([np.searchsorted(ranked[d], values[:, d]) for d in range(width)], axis=1)
    left = right - 1
    seen = np.zeros((n, k), bool)
    best = np.full(n, np.iinfo(np.int64).max, np.int64)
    label = np.full(n, -1, np.int64)
    walking = np.arange(n)
    computed = 0
    big = np.iinfo(np.int64).max
    for _ in range(k):
        if walking.size == 0:
            break
        v = values[walking]
        lo, hi = left[walking], right[walking]
        gap_lo = np.where(lo >= 0, v - ranked[dims, np.clip(lo, 0, k - 1)], big)
        gap_hi = np.where(hi < k, ranked[dims, np.clip(hi, 0, k - 1)] - v, big)
        take_lo = np.abs(gap_lo) <= np.abs(gap_hi)
        shown = np.where(take_lo, order[dims, np.clip(lo, 0, k - 1)], order[dims, np.clip(hi, 0, k - 1)])
        left[walking] = np.where(take_lo, lo - 1, lo)
        right[walking] = np.where(take_lo, hi, hi + 1)
        fresh = np.zeros((walking.size, k), bool)
        fresh[np.repeat(np.arange(walking.size), width), shown.ravel()] = True
        fresh &= ~seen[walking]
        seen[walking] |= fresh
        rows, numbers = np.nonzero(fresh)
        computed += rows.size
        if rows.size:
            d = values[walking[rows]] - centroids[numbers]
            dist = np.einsum("ij,ij->i", d, d)
            # per row the lexicographically smallest (distance, number) of the new ones
            pick = np.lexsort((numbers, dist, rows))
            rows, numbers, dist = rows[pick], numbers[pick], dist[pick]
            first = np.r_[True, rows[1:] != rows[:-1]]
            rows, numbers, dist = rows[first], numbers[first], dist[first]
            g = walking[rows]
            better = (dist < best[g]) | ((dist == best[g]) & (numbers < label[g]))
            best[g[better]], label[g[better]] = dist[better], numbers[better]
        # frontier: the smallest gap any list still holds; lists run out at k steps
        lo, hi = left[walking], right[walking]
        v = values[walking]
        next_lo = np.where(lo >= 0, v - ranked[dims, np.clip(lo, 0, k - 1)], big)
        next_hi = np.where(hi < k, ranked[dims, np.clip(hi, 0, k - 1)] - v, big)
        frontier = np.minimum(np.abs(next_lo), np.abs(next_hi))
        exhausted = (frontier == big).any(axis=1)
        bound = (np.where(exhausted[:, None], 0, frontier) ** 2).sum(axis=1)
        done = exhausted | (bound > best[walking])
        walking = walking[~done]
    return label, best, computed


def _assign(centroids: np.ndarray, width: int, sums: bool):
    """mapInArrow function: (vec_id, x) -> (vec_id, x, cluster, distance), or per-batch cluster sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("x"))
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            values = flat.reshape(len(batch), width)
            label, dist, _ = nearest(values, centroids)
            if not sums:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("vec_id")), column,
                     pa.array(label.astype(np.int32)), pa.array(dist)],
                    ["vec_id", "x", "cluster", "distance"],
                )
                continue
            found = np.unique(label)
            total = np.zeros((len(found), width), np.int64)
            np.add.at(total, np.searchsorted(found, label), values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int32)), pa.array(np.bincount(label)[found].astype(np.int64)),
                 pa.array(list(total), pa.list_(pa.int64()))],
                ["cluster", "n", "total"],
            )

    return run


def _next_centroids(kept: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Every non-empty centroid replaced by the floor of its vectors' mean; empty ones stay."""
    partial = kept.mapInArrow(_assign(centroids, width, sums=True), "cluster int, n long, total array<long>")
    sums = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
    )
    out = centroids.copy()
    for row in sums.collect():                          # at most one row per centroid
        s = np.array([row[f"s{i}"] for i in range(width)], dtype=object)
        out[row["cluster"]] = [v // row["n"] for v in s]   # exact floor of the mean
    return out


def centroid_digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def first_centroids(kept: DataFrame, clusters: int, seed: int = 1) -> np.ndarray:
    """The ``clusters`` kept vectors with the smallest hex sha256 of '<seed>:<vec_id>', in that order.

    Rows without vec_id are never chosen; equal hashes (a repeated id) go by the vector.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.filter(F.col("vec_id").isNotNull()).orderBy(key, "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64).reshape(len(rows), -1 if rows else 0)


def kmeans(vectors: DataFrame, clusters: int = 16, rounds: int = 3, width: int = 64) -> DataFrame:
    """Cluster the vectors of ``vectors`` (vec_id, embedding) on integer components.

    Kept are vectors of exactly ``width`` components, none null or non-finite; others are
    left out of the result. Components become floor(64 * x). Centroids start as the
    ``clusters`` kept vectors of smallest sha256 of '1:<vec_id>' (fewer if fewer are kept);
    each of ``rounds`` rounds assigns every vector (squared Euclidean distance, ties to the
    smaller centroid number) and replaces every non-empty centroid by the exact floor of its
    vectors' componentwise mean. A last assignment gives the result: one row per kept input
    row (repeated rows each), vec_id (null stays null), cluster, distance, cluster_inertia,
    inertia and centroid_sha256 (sha256 of the final centroid's integers joined by ',').
    An empty or wholly dropped input gives no rows. Distances are 64-bit integers: components
    must stay below about 2^27 in size. Extra columns of ``vectors`` are not carried.
    """
    spark = vectors.sparkSession
    kept = integer_vectors(vectors.select("vec_id", "embedding"), width)
    centroids = first_centroids(kept, clusters)
    if len(centroids) == 0:
        schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                  "centroid_sha256 string")
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = _next_centroids(kept, centroids, width)
    assigned = kept.mapInArrow(
        _assign(centroids, width, sums=False), "vec_id long, x array<long>, cluster int, distance long"
    ).drop("x")
    digests = spark.createDataFrame(
        [(number, centroid_digest(c)) for number, c in enumerate(centroids)], "cluster int, centroid_sha256 string"
    )
    per_cluster = (
        assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
        .join(digests, "cluster")
        .withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))  # at most `clusters` rows
    )
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def exact_nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Brute force: all distances, the smallest with its smallest number."""
    d = ((values[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    label = d.argmin(axis=1)
    return label, d[np.arange(len(values)), label]

