"""All pairs of vectors above a cosine threshold, by dual traversal of a cover tree.

On the unit sphere a cosine is a distance. Bounded pivots deal the vectors into top nodes, and
large top nodes into blocks, so that no task holds more than a block; nodes further down are built
in the tasks, in levels whose radii halve. Pairs of nodes are visited from the top: a pair whose
centres are farther apart than both covering radii and the threshold allow is pruned, one that is within the threshold
as a whole is taken without looking inside, any other is split. Pairs of leaves are
compared exactly, by the cosine itself.

The blocks are written once, each with its tree, and meet in a Cartesian product that reads them again,
with the bounds as its condition: no pair of blocks goes through a shuffle or to disk, and no tree is
built a second time. A block's rows stand in the order of its leaves, so every node is a run of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.llm.components import connected_components
from stocklens.llm.shared import written
from stocklens.llm.voronoi import _matrix

PIVOTS = 256
LEAF = 96
PAIRS = 16_384  # of rows, compared in double precision at once
TREES = 32  # trees of blocks that a task keeps for the next pairs
SLACK = 1e-9
TREE = "sizes array<int>, radii array<double>, below array<int>"  # nodes from the top, each before its children


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: np.ndarray  # row numbers below it
    children: list[Node] = field(default_factory=list)

    def __len__(self) -> int:
        return len(self.rows)


@dataclass
class Run:
    """A node of a block whose rows are in the order of their leaves; the first row is its centre."""

    centre: np.ndarray
    radius: float
    first: int
    end: int
    children: list[Run] = field(default_factory=list)

    def __len__(self) -> int:
        return self.end - self.first

    @property
    def rows(self) -> slice:
        return slice(self.first, self.end)


@dataclass
class Block:
    units: np.ndarray
    ids: np.ndarray
    tree: Run
    rough: np.ndarray = field(init=False)  # units in single precision

    def __post_init__(self) -> None:
        self.rough = self.units.astype(np.float32)


def build(units: np.ndarray, rows: np.ndarray, scale: float) -> Node:
    """A cover tree: each level's centres are more than its radius apart, radii halve."""
    centre = units[rows[0]]
    radius = float(np.sqrt(((units[rows] - centre) ** 2).sum(1).max()))
    node = Node(centre, radius, rows)
    if len(rows) <= LEAF or radius <= 1e-7:
        return node
    while scale >= radius:
        scale /= 2
    left = rows
    while len(left):
        far = np.sqrt(((units[left] - units[left[0]]) ** 2).sum(1))
        node.children.append(build(units, left[far <= scale], scale / 2))
        left = left[far > scale]
        if len(node.children) > 4 * LEAF:  # scattered rows: smaller radii would only make singletons
            return Node(centre, radius, rows)
    return node


def _leaves(node: Node) -> list[np.ndarray]:
    return [rows for c in node.children for rows in _leaves(c)] if node.children else [node.rows]


def _nodes(node: Node) -> list[Node]:
    return [node, *(n for c in node.children for n in _nodes(c))]


def _runs(units: np.ndarray, nodes: Iterator[tuple[int, float, int]], first: int = 0) -> Run:
    """The tree of a block from its nodes (rows, radius, children), each before its children."""
    size, radius, below = next(nodes)
    run = Run(units[first], radius, first, first + size)
    for _ in range(below):
        run.children.append(_runs(units, nodes, run.children[-1].end if run.children else first))
    return run


def similar_vectors(
    embeddings: DataFrame, *, threshold: float = 0.9, block_rows: int = 2048
) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Vectors with cosine >= threshold (0 < threshold <= 1) in double precision are linked. n_links counts
    the other rows linked directly, component_id is the smallest vec_id reachable, itself included,
    and kept says that it is the row's own. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, and vectors of different lengths do not link. Rows without an id have
    no links, component_id null and are kept. Rows that repeat an id count as one
    vector each while they share their class. Other columns are ignored.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & finite & F.exists("x", lambda c: c != 0), F.lit(False)
    )
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", x.alias("x"))
    element = embeddings.schema["embedding"].dataType.elementType
    kept = F.col("embedding") if isinstance(element, T.FloatType) else F.col("x")
    vectors = rows.filter(usable).select("vec_id", kept.alias("x"))
    blocks = _blocks(vectors, block_rows)
    found = _pairs(blocks, threshold)
    links = found.filter("n > 0").groupBy("block", "place").agg(F.sum("n").alias("n_links"))
    classes = connected_components(found.filter("other is not null").select("vec_id", "other"), "vec_id", "other")
    members = blocks.select("block", F.posexplode("rows.vec_id").alias("place", "vec_id"))
    return (
        members.join(links, ["block", "place"], "left")
        .select("vec_id", "n_links")
        .unionByName(rows.filter(~usable).select("vec_id", F.lit(None).cast("long").alias("n_links")))
        .join(classes, F.col("vec_id") == F.col("node"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _blocks(vectors: DataFrame, block_rows: int) -> DataFrame:
    """Blocks (d, cell, radius, apart, block, rows and the columns of TREE) of about ``block_rows``
    vectors near one pivot, in the order of the leaves of their tree.

    ``apart`` holds the distances from the block's pivot to every pivot of its length.
    """
    spark = vectors.sparkSession
    wanted = min(PIVOTS, -(-2 * vectors.count() // block_rows))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
    by_length: dict[int, list] = {}
    for r in sample:
        by_length.setdefault(len(r.x), []).append(r.x)
    pivots = {d: _units(np.array(v, np.float64)) for d, v in by_length.items()}
    shared = spark.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, far = [], []
            for v in batch.column(1):
                unit = _units(np.array([v.as_py()], np.float64))[0]
                known = shared.value.get(len(unit))
                if known is None:  # a length without a pivot
                    cells.append(-1)
                    far.append(2.0)
                else:
                    away = np.sqrt(((known - unit) ** 2).sum(1))
                    cells.append(int(away.argmin()))
                    far.append(float(away.min()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([len(v) for v in batch.column(1)], pa.int32()),
                    pa.array(cells, pa.int32()),
                    pa.array(far, pa.float64()),
                ],
                names=["vec_id", "x", "deal", "d", "cell", "far"],
            )

    x = vectors.schema["x"].dataType.simpleString()
    # placed twice, for the sizes of the cells and for the blocks, instead of written
    placed = vectors.withColumn("deal", F.monotonically_increasing_id()).mapInArrow(
        place, f"vec_id long, x {x}, deal long, d int, cell int, far double"
    )
    sizes = placed.groupBy("d", "cell").agg(F.count("*").alias("n"))
    part = F.pmod(F.col("deal"), F.ceil(F.col("n") / block_rows)).cast("int")
    between = [
        (d, cell, [float(a) for a in np.sqrt(((known - known[cell]) ** 2).sum(1))])
        for d, known in pivots.items()
        for cell in range(len(known))
    ]
    apart = spark.createDataFrame(between, "d int, cell int, apart array<double>")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, rows = batch.slice(i, 1), batch.column(batch.num_columns - 1)[i].values
                units = _units(_matrix(rows.field("x")).astype(np.float64))
                tree = build(units, np.arange(len(units)), 2.0)
                nodes = _nodes(tree)
                ordered = pa.ListArray.from_arrays(
                    pa.array([0, len(rows)], pa.int32()), rows.take(pa.array(np.concatenate(_leaves(tree))))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *one.columns[:-1],
                        ordered,
                        pa.array([[len(n) for n in nodes]], pa.list_(pa.int32())),
                        pa.array([[n.radius for n in nodes]], pa.list_(pa.float64())),
                        pa.array([[len(n.children) for n in nodes]], pa.list_(pa.int32())),
                    ],
                    names=[*batch.schema.names, "sizes", "radii", "below"],
                )

    return written(
        placed.join(F.broadcast(sizes), ["d", "cell"])
        .withColumn("part", part)
        .groupBy("d", "cell", "part")
        .agg(F.max("far").alias("radius"), F.collect_list(F.struct("vec_id", "x")).alias("rows"))
        .join(F.broadcast(apart), ["d", "cell"], "left")
        .select("d", "cell", "radius", "apart", F.concat_ws("/", "d", "cell", "part").alias("block"), "rows")
        .mapInArrow(
            grow,
            "d int, cell int, radius double, apart array<double>, block string, "
            f"rows array<struct<vec_id: bigint, x: {x}>>, {TREE}",
        )
    )


def _pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """(block, place, n) counts of links and (vec_id, other) forest edges, from every pair of blocks."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    held = F.struct(F.col("rows.vec_id").alias("vec_id"), F.col("rows.x").alias("x"), "sizes", "radii", "below")
    a = blocks.select("d", "radius", "apart", F.col("block").alias("a"), held.alias("first"))
    b = blocks.select(
        F.col("d").alias("other_d"),
        F.col("cell").alias("other_cell"),
        F.col("radius").alias("other_radius"),
        F.col("block").alias("b"),
        held.alias("second"),
    )
    between = F.coalesce(F.get("apart", F.greatest("other_cell", F.lit(0))), F.lit(0.0))
    near = between - F.col("radius") - F.col("other_radius") <= reach + SLACK
    pairs = a.hint("shuffle_replicate_nl").join(
        b, (F.col("d") == F.col("other_d")) & (F.col("a") <= F.col("b")) & near
    )

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, Block] = {}

        def block(name: str, held: pa.StructScalar) -> Block:
            if name not in kept:
                if len(kept) >= TREES:
                    del kept[next(iter(kept))]
                units = _units(_matrix(held["x"].values).astype(np.float64))
                nodes = zip(*(held[c].values.to_pylist() for c in ("sizes", "radii", "below")), strict=True)
                kept[name] = Block(units, held["vec_id"].values.to_numpy(), _runs(units, nodes))
            return kept[name]

        for batch in batches:
            for i in range(batch.num_rows):
                names = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                both = [block(k, batch.column(2 + c)[i]) for c, k in enumerate(names)]
                yield _dual(names, both, threshold, reach)

    return written(
        pairs.select("a", "b", "first", "second").mapInArrow(
            traverse, "block string, place int, n long, vec_id long, other long"
        )
    )


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def _dual(
    names: tuple[str, str],
    blocks: list[Block],
    threshold: float,
    reach: float,
) -> pa.RecordBatch:
    """Traverse the trees of two blocks; counts per row, and edges that connect what links connect."""
    first, second = blocks
    u, v, tree, other = first.units, second.units, first.tree, second.tree
    same = names[0] == names[1]
    mine, theirs = np.zeros(len(u), np.int64), np.zeros(len(v), np.int64)
    # a forest over rows of the first block, then of the second
    label = np.arange(len(u) if same else len(u) + len(v))
    shift = 0 if same else len(u)
    edges: list[tuple[int, int]] = []

    def join(i: int, j: int) -> None:
        if label[i] != label[j]:
            edges.append((i, j))
            label[label == label[j]] = label[i]

    def joined(a: Run, b: Run) -> None:
        """Every row of a is linked with every row of b."""
        for j in range(b.first, b.end):
            join(a.first, shift + j)
        for i in range(a.first + 1, a.end):
            join(i, shift + b.first)

    stack = [(tree, other)]
    while stack:
        p, q = stack.pop()
        apart = float(np.sqrt(((p.centre - q.centre) ** 2).sum()))
        if apart - p.radius - q.radius > reach + SLACK:
            continue
        if same and p is q:
            if 2 * p.radius < reach - SLACK:
                mine[p.rows] += len(p) - 1
                joined(p, p)
            elif p.children:
                for i, c in enumerate(p.children):
                    stack.extend((c, e) for e in p.children[i:])
            else:
                _leaf(first, second, p, q, True, threshold, mine, mine, join, label, shift)
        elif apart + p.radius + q.radius < reach - SLACK:
            mine[p.rows] += len(q)
            theirs[q.rows] += len(p)
            joined(p, q)
        elif p.children and (p.radius >= q.radius or not q.children):
            stack.extend((c, q) for c in p.children)
        elif q.children:
            stack.extend((p, c) for c in q.children)
        else:
            _leaf(first, second, p, q, False, threshold, mine, theirs, join, label, shift)
    if same:
        mine = mine + theirs
    every, counts = (first.ids, mine) if same else (np.concatenate((first.ids, second.ids)), np.concatenate((mine, theirs)))
    hit = np.flatnonzero(counts)
    n, m = len(hit), len(edges)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([names[0] if i < len(u) else names[1] for i in hit] + [None] * m, pa.string()),
            pa.array(np.concatenate((np.where(hit < len(u), hit, hit - len(u)), np.zeros(m, np.int64))), pa.int32()),
            pa.array(np.concatenate((counts[hit], np.zeros(m, np.int64)))),
            pa.array([None] * n + [int(every[i]) for i, _ in edges], pa.int64()),
            pa.array([None] * n + [int(every[j]) for _, j in edges], pa.int64()),
        ],
        names=["block", "place", "n", "vec_id", "other"],
    )


def _leaf(u, v, a, b, own, threshold, mine, theirs, join, label, shift) -> None:  # noqa: ANN001
    """Links between the rows of two leaves: single precision finds where to look, double precision decides."""
    d = u.units.shape[1]
    rough = u.rough[a.rows] @ v.rough[b.rows].T
    near = np.flatnonzero(rough >= np.float32(threshold - (d + 8) * 2.0**-23))  # its rounding errors are smaller
    if own:
        near = near[near // len(b) != near % len(b)]
    whole = (u.units[a.rows] @ v.units[b.rows].T).ravel() if 32 * len(near) > rough.size else None
    for k in range(0, len(near), PAIRS):
        at = near[k : k + PAIRS]
        i, j = a.first + at // len(b), b.first + at % len(b)
        cosine = np.einsum("ij,ij->i", u.units[i], v.units[j]) if whole is None else whole[at]
        for c in np.flatnonzero(np.abs(cosine - threshold) < 1e-12):  # sums in another order differ in the last bit
            cosine[c] = float(np.dot(u.units[i[c]], v.units[j[c]]))
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        mine += np.bincount(i, minlength=len(mine))
        if not own:
            theirs += np.bincount(j, minlength=len(theirs))
        apart = label[i] != label[shift + j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
            join(x, shift + y)
