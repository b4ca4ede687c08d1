"""Near-duplicate texts by a chosen-path set similarity join.

Every distinct shingle set is one record. A record sits in the root of several
independent trees. A node of a tree branches by a few minwise coordinates that
the node itself chooses: a record goes to the child named by (node, coordinate,
its value there), so that two sets of similarity J share a child with probability
J per coordinate. Nodes of at most ``leaf`` records are compared exhaustively, by
signatures first and then on the full sets; larger ones branch again.

A node that stays large holds either one tight group or a loose family. So the
records of a large node are also compared with a few pivot
records, where signatures agree, and links found so far are joined into components. Links within a component change
no class: a node of one component is done, and where few records are outside the
largest component, only they are compared with all. What is left branches on. Nodes of the first two levels choose two coordinates each; deeper
ones about 1/threshold, so that work per level does not grow for families below the
threshold. The chance that a pair at the threshold itself is missed by all of four
trees is about 1e-4 in a deep family and below 1e-6 where one level suffices.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.components import connected_components
from stocklens.llm.shared import texts_of, written
from stocklens.llm.shingles import shingle_sets, signatures

SIGNATURE = 128
FILTER_WORDS = 1 << 18  # 64-bit words of the filter of ids
PIVOTS = 4  # records of a large node that all its records are compared with
WIDE_LEVELS = 2  # levels at which a node chooses two coordinates


def near_duplicates(
    documents: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    trees: int = 4,
    leaf: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, kept.

    Two texts are linked when 100 * |A and B| >= percent * |A or B| on their sets of
    distinct ``words``-word shingles; every reported link is confirmed on the full sets.
    component_id is the smallest id reachable by links, itself included; kept says
    that it is the row's own. Texts that are null, empty or without words have 0
    shingles and are linked with nothing; a row without an id is its own class
    (component_id null, kept). Repeated ids each keep a row. Other columns are ignored.
    """
    docs = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    base = written(
        docs.mapInArrow(
            _describe(words, _roots(trees)),
            "doc_id long, n_shingles long, set_key binary, first array<int>, sig array<short>",
        )
    )
    reps = written(
        base.filter("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.first("first").alias("first"), F.first("sig").alias("sig"))
    )
    edges = _links(docs, reps.select("rep", "first", "sig"), words, percent, trees, leaf)
    classes = connected_components(edges)
    named = reps.join(classes, F.col("rep") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "rep").alias("component_id")
    )
    return (
        base.drop("first", "sig")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
                "component_id"
            ),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _roots(trees: int) -> list[int]:
    """The coordinates by which the roots branch."""
    return random.Random(5).sample(range(SIGNATURE), 2 * trees)


def _describe(words: int, roots: list[int]):
    def arrays(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
        offsets = np.concatenate(([0], np.cumsum(counts * values.shape[1])))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, "text"):
            ids = batch.column(0)
            # a slice at a time bounds the memory of the signature pass
            for lo in range(0, len(texts), 512):
                part = list(shingle_sets(texts[lo : lo + 512], words))
                full = [s for s in part if len(s)]
                sig = signatures(full, SIGNATURE) if full else np.empty((0, SIGNATURE), np.int32)
                filled = np.array([len(s) > 0 for s in part], np.int64)
                keys = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in part
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, len(part)),
                        pa.array([len(s) for s in part], pa.int64()),
                        pa.array(keys, pa.binary()),
                        arrays(filled, np.ascontiguousarray(sig[:, roots])),
                        # half of each value: below the roots a node has few records to part
                        arrays(filled, (sig & 0xFFFF).astype(np.uint16).view(np.int16)),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "first", "sig"],
                )

    return run


def _links(
    docs: DataFrame, reps: DataFrame, words: int, percent: int, trees: int, leaf: int
) -> DataFrame:
    """Confirmed links (a, b) that connect all records which links connect."""
    children = F.transform("first", lambda value, k: F.xxhash64(k, value))
    rows = _with_component(reps.select("rep", F.explode(children).alias("node")), None)
    reps = reps.select("rep", "sig")
    edges, known, groups, level, compared = None, None, [], 1, False
    while True:
        live = written(_impure(rows))
        small = (F.col("n") <= leaf) | (F.col("rest") <= leaf)
        groups.append(written(_alike(_leaves(live.filter(small), leaf), reps, percent)))
        big = live.filter(~small)
        if big.isEmpty():
            break
        if level > 1 or not compared:
            stars = written(_confirmed(_stars(big, reps, percent), docs, words, percent))
            edges = stars if edges is None else edges.unionByName(stars)
            known = connected_components(edges)
        if not compared:  # what pivots connect is done, or nearly, before anything branches
            compared = True
            rows = _with_component(big.select("node", "rep"), known)
            continue
        level += 1
        rows = _children(big.select("node", "rep"), reps, known, level, percent)
    solved = _solved(groups, docs, known, words, percent)
    return solved if edges is None else solved.unionByName(edges)


def _likely(rows: DataFrame, id_column: str, pool: DataFrame, pool_column: str) -> DataFrame:
    """The rows whose id is in the pool, and few others: those whose bit the pool's ids set.

    The filter has a fixed size and is broadcast, so most texts or sets outside the pool
    are not shuffled to be joined with it; the exact join follows.
    """

    def word(key: str) -> Column:
        return F.pmod(F.shiftright(F.xxhash64(key), 6), F.lit(FILTER_WORDS))

    def bit(key: str) -> Column:
        return F.expr(f"shiftleft(1L, cast(pmod(xxhash64({key}), 64) as int))")

    bits = pool.groupBy(word(pool_column).alias("word")).agg(F.bit_or(bit(pool_column)).alias("bits"))
    return (
        rows.join(F.broadcast(bits), word(id_column) == F.col("word"))
        .filter(F.col("bits").bitwiseAND(bit(id_column)) != 0)
        .select(*rows.columns)
    )


def _child(node: Column, coordinate: Column) -> Column:
    index = coordinate + 1
    return F.xxhash64(node, index, F.element_at("sig", index))


def _children(
    rows: DataFrame, reps: DataFrame, known: DataFrame | None, level: int, percent: int
) -> DataFrame:
    choose = [F.pmod(F.xxhash64(F.lit(k), "node"), F.lit(SIGNATURE)).cast("int") for k in (1, 2)]
    second = _child(F.col("node"), choose[1])
    if level > WIDE_LEVELS:
        rare = F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(100)) < 100 * 100 // percent - 100
        second = F.when(rare, second)
    children = F.filter(F.array(_child(F.col("node"), choose[0]), second), lambda x: x.isNotNull())
    children = rows.join(reps, "rep").select(
        "rep", F.explode(F.array_distinct(children)).alias("node")
    )
    return _with_component(children, known)


def _with_component(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return rows.withColumn("comp", F.col("rep"))
    members = known.select(F.col("node").alias("member"), "component")
    return (
        rows.join(members, F.col("rep") == F.col("member"), "left")
        .withColumn("comp", F.coalesce("component", "rep"))
        .drop("member", "component")
    )


def _impure(rows: DataFrame) -> DataFrame:
    """Rows of nodes with records of two components at least.

    Adds the size n of the node, whether the record is in the node's largest
    component (main), and how many records are (main_n) and are not (rest).
    """
    nodes = (
        rows.groupBy("node", "comp")
        .agg(F.count("*").alias("c"))
        .groupBy("node")
        .agg(
            F.sum("c").alias("n"),
            F.max(F.struct("c", "comp")).alias("top"),
            F.count("*").alias("comps"),
        )
        .filter("comps > 1")
    )
    return rows.join(nodes, "node").select(
        "node",
        "rep",
        "n",
        (F.col("comp") == F.col("top.comp")).alias("main"),
        F.col("top.c").alias("main_n"),
        (F.col("n") - F.col("top.c")).alias("rest"),
    )


def _least(percent: int) -> int:
    """Equal coordinates that a similar pair has at least, but for one in ten million."""
    similar = percent / 100
    return int(SIGNATURE * similar - 5.2 * (SIGNATURE * similar * (1 - similar)) ** 0.5)


def _stars(big: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (rep, other) of each record of a node with the node's pivots, if signatures agree.

    Pivots are the records that agree in most coordinates with the commonest values of
    a small sample of the node: copies of one text are like it more than like each other.
    """

    def commonest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres = []
            for rows in batch.column(1):
                centre = []
                for column in np.array(rows.as_py(), np.int32).T:
                    values, counts = np.unique(column, return_counts=True)
                    centre.append(int(values[counts.argmax()]))
                centres.append(centre)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(centres, pa.list_(pa.int32()))], names=["node", "centre"]
            )

    rows = big.select("node", "rep", "n").join(reps, "rep")
    sampled = F.pmod(F.xxhash64("node", "rep"), F.ceil(F.col("n") / 64)) == 0
    centres = (
        rows.filter(sampled)
        .groupBy("node")
        .agg(F.collect_list("sig").alias("sigs"))
        .mapInArrow(commonest, "node long, centre array<int>")
    )
    def equal(x: Column, y: Column) -> Column:
        same = F.zip_with(x, y, lambda a, b: (a == b).cast("int"))
        return F.aggregate(same, F.lit(0), lambda a, b: a + b)

    near = F.struct(equal(F.col("sig"), F.col("centre")), "rep", "sig")
    best = [
        F.max(F.when(F.pmod(F.xxhash64("rep"), F.lit(PIVOTS)) == k, near)) for k in range(PIVOTS)
    ]
    pivots = (
        rows.join(centres, "node")
        .groupBy("node")
        .agg(F.array_compact(F.array(*best)).alias("pivots"))
    )
    return (
        rows.join(pivots, "node")
        .select("rep", "sig", F.explode("pivots").alias("pivot"))
        .filter(equal(F.col("sig"), F.col("pivot.sig")) >= _least(percent))
        .select("rep", F.col("pivot.rep").alias("other"))
    )


def _leaves(live: DataFrame, leaf: int) -> DataFrame:
    """(node, rep) of the groups to compare exhaustively.

    A node with few records outside its largest component needs those compared with
    all; its largest component is dealt into blocks and each block meets all the others.
    """
    blocks = F.when(F.col("n") <= leaf, 1).otherwise(F.ceil(F.col("main_n") / leaf)).cast("int")
    own = F.array(F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    block = F.explode(F.when(F.col("main"), own).otherwise(F.sequence(F.lit(0), blocks - 1)))
    return live.select("node", "rep", block.alias("block")).select(
        F.xxhash64("node", "block").alias("node"), "rep"
    )


def _alike(leaves: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct groups (key, members) of records in one leaf that signatures connect."""
    least = _least(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(0).offsets.to_numpy()
            rows = batch.column(0).values
            ids = rows.field("rep").to_numpy()
            sig = rows.field("sig").values.to_numpy(zero_copy_only=False).reshape(-1, SIGNATURE)
            keys, members = [], []
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                for group in _connected(sig[lo:hi], least):
                    group = np.sort(ids[lo:hi][group])
                    keys.append(hashlib.blake2b(group.tobytes(), digest_size=16).digest())
                    members.append(group.tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(members, pa.list_(pa.int64()))],
                names=["key", "members"],
            )

    return (
        leaves.select("node", "rep")
        .join(reps, "rep")
        .groupBy("node")
        .agg(F.collect_list(F.struct("rep", "sig")).alias("rows"))
        .select("rows")
        .mapInArrow(run, "key binary, members array<long>")
        .groupBy("key")
        .agg(F.first("members").alias("members"))
    )


def _connected(sig: np.ndarray, least: int) -> list[np.ndarray]:
    """Groups of two rows at least that are connected by ``least`` equal coordinates."""
    n = len(sig)
    label = np.arange(n)
    for i in range(n - 1):
        for j in np.flatnonzero((sig[i + 1 :] == sig[i]).sum(1) >= least) + i + 1:
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
    values, counts = np.unique(label, return_counts=True)
    return [np.flatnonzero(label == v) for v in values[counts > 1]]


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, "text"):
            for lo in range(0, len(texts), 512):
                sets = [s.tobytes() for s in shingle_sets(texts[lo : lo + 512], words)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(sets)), pa.array(sets, pa.binary())],
                    names=["rep", "members"],
                )

    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _forest(
    sets: list[np.ndarray], label: np.ndarray, percent: int
) -> Iterator[tuple[int, int]]:
    """Links (i, j) of similar sets that join different labels; ``label`` is changed."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[k]) for k in order])
    label = label[order]
    values, ids = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    inside = np.zeros(len(values), np.int32)
    for i in range(len(sets) - 1):
        # larger sets that are small enough to be similar
        last = int(np.searchsorted(sizes, 100 * sizes[i] // percent, "right"))
        if last <= i + 1 or (label[i + 1 : last] == label[i]).all():
            continue
        own = ids[starts[i] : ends[i]]
        inside[own] = 1
        lo = starts[i + 1]
        common = np.add.reduceat(inside[ids[lo : ends[last - 1]]], starts[i + 1 : last] - lo)
        inside[own] = 0
        similar = 100 * common >= percent * (sizes[i] + sizes[i + 1 : last] - common)
        for j in np.flatnonzero(similar) + i + 1:
            if label[i] != label[j]:
                yield int(order[i]), int(order[j])
                label[label == label[j]] = label[i]


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (rep, other) whose full sets are similar, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = [
                _linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(x, y, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 1)], names=["a", "b"]
            )

    pairs = written(pairs.filter("rep <> other").distinct())
    ids = pairs.select("rep").unionByName(pairs.select(F.col("other").alias("rep")))
    sets = written(_texts(docs, ids).mapInArrow(_sets(words), "rep long, members binary"))
    left = sets.select("rep", F.col("members").alias("x"))
    right = sets.select(F.col("rep").alias("other"), F.col("members").alias("y"))
    x, y = F.octet_length("x"), F.octet_length("y")
    return (
        pairs.join(left, "rep")
        .join(right, "other")
        .filter(100 * F.least(x, y) >= percent * F.greatest(x, y))
        .select("rep", "other", "x", "y")
        .mapInArrow(run, "a long, b long")
    )


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, text) of the ids and few others, one row each."""
    likely = _likely(docs, "doc_id", ids, "rep").dropDuplicates(["doc_id"])
    return likely.withColumnRenamed("doc_id", "rep")


def _solved(
    groups: list[DataFrame], docs: DataFrame, known: DataFrame | None, words: int, percent: int
) -> DataFrame:
    """Links that connect what links connect within each group, confirmed on full sets.

    In a group every pair is tried unless its records are already connected. Texts are
    shuffled, as they compress and sets of hashes do not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(0).offsets.to_numpy()
            rows = batch.column(0).values
            ids, comps = rows.field("rep").to_numpy(), rows.field("comp").to_numpy()
            texts, a, b = rows.field("text"), [], []
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                group = list(shingle_sets(texts.slice(lo, hi - lo).to_pylist(), words))
                for i, j in _forest(group, comps[lo:hi].copy(), percent):
                    a.append(ids[lo + i])
                    b.append(ids[lo + j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    every = groups[0]
    for more in groups[1:]:
        every = every.unionByName(more)
    rows = every.dropDuplicates(["key"]).select("key", F.explode("members").alias("rep"))
    texts = _texts(docs, rows.select("rep"))
    rows = _with_component(rows, known)
    return written(
        rows.join(texts, "rep")
        .groupBy("key")
        .agg(F.collect_list(F.struct("rep", "comp", "text")).alias("rows"))
        .select("rows")
        .mapInArrow(run, "a long, b long")
    )
