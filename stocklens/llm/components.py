"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.shared import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of ``edges`` the smallest node it reaches.

    Rounds of contraction: each node points at its smallest neighbour where that is
    smaller than itself, pointers are followed to their roots, edges are renamed to
    the roots and made distinct; it ends when no edge is left. Every step is a join
    or a grouping with partial sums, so a node with very many edges is no hot task.
    Edges with a NULL end, self-loops and repeats add nothing.
    """
    left = written(
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct()
    )
    labels = None
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            left.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        roots = _followed(
            both.groupBy("node").agg(F.min("other").alias("up")).select(
                "node", F.least("node", "up").alias("up")
            )
        )
        if labels is None:
            labels = roots.select("node", F.col("up").alias("component"))
        else:
            labels = written(_renamed(labels, "component", roots))
        left = written(
            _renamed(_renamed(left, "a", roots), "b", roots)
            .filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _renamed(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    to = roots.select(F.col("node").alias("__node"), F.col("up").alias("__up"))
    return (
        df.join(to, F.col(column) == F.col("__node"), "left")
        .withColumn(column, F.coalesce("__up", column))
        .drop("__node", "__up")
    )


def _followed(parents: DataFrame) -> DataFrame:
    """Point every node of a forest at its root by doubling the pointers."""
    parents = written(parents)
    while True:
        above = parents.filter("node <> up").select(
            F.col("node").alias("__node"), F.col("up").alias("__up")
        )
        # whether a pointer moved is written along, so that no join runs a second time to ask
        further = written(
            parents.join(above, F.col("up") == F.col("__node"), "left").select(
                "node",
                F.coalesce("__up", "up").alias("up"),
                F.col("__node").isNotNull().alias("moved"),
            )
        )
        parents = further.drop("moved")
        if further.filter("moved").isEmpty():
            return parents
