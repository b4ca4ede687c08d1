"""A prefix tree of conversations, built as ternary search trees per range shard.

Turns are dictionary-encoded: a turn (role, text) becomes a 96-bit id (two hashes of its
content), so conversations are sequences of ids. Equal conversations are collapsed first:
one sort by sequence and conversation streams each group once, counting members and
hashing the ids of those that end there. The distinct sequences are range-partitioned, so
that every shard holds a contiguous run of the sorted sequences. A task inserts its run into
a ternary search tree, middle sequence first (balanced without rotations), and walks the
nodes once in reverse creation order, which is bottom-up: members, children, leaves and
saved tokens accumulate there.

A prefix lies in a contiguous run of shards. Only prefixes of a shard's first or last
sequence (and the root) can reach into another shard: these boundary nodes leave the task
as partial sums and are merged in Spark; all other nodes are whole in their shard and leave
it final. Boundary nodes are at most two paths per shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.shared import written

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
WORDS = r"[^\x20\x09-\x0D]+"
NODE_SCHEMA = (
    "kind string, key1 long, key2 long, pkey1 long, pkey2 long, depth long, n_convs long, conv_id long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, parent_conv_id long, "
    "parent_boundary boolean, anc1 array<long>, anc2 array<long>"
)


def rebuilt(conversations: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, seq) per conv_id: seq the rebuilt turns as (t1, t2, words) structs, in order.

    Turns are ordered by turn (null first), then role and text; null role or text is empty.
    Conversation c takes the first h = crc32(c) % ``heads`` turns of conversation
    c - c % ``block`` (all if fewer, none if absent), then its own turns after its first h.
    Rows without conv_id are left out.
    """
    t = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = t.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("i"),
        F.xxhash64("role", "text").alias("t1"),
        F.hash("role", "text").cast("long").alias("t2"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("w"),
    )
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    ids = t.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), head.alias("h")
    )
    own = t.filter(F.col("i") >= F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)))
    base = (
        t.filter(F.col("i") < heads).withColumnRenamed("conv_id", "base")
        .join(ids, "base").filter(F.col("i") < F.col("h"))
        .select("conv_id", "i", "t1", "t2", "w")
    )
    seqs = own.unionByName(base).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("i", "t1", "t2", "w"))).alias("turns")
    )
    return ids.join(seqs, "conv_id", "left").select(
        "conv_id",
        F.transform(
            F.coalesce("turns", F.array().cast("array<struct<i:long,t1:long,t2:long,w:long>>")),
            lambda x: F.struct(x["t1"].alias("t1"), x["t2"].alias("t2"), x["w"].alias("w")),
        ).alias("seq"),
    )


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (seq, conv_id) rows -> per sequence: members, smallest, sha256 of the ids joined by ','."""
    out = {"seq": [], "n_end": [], "min_end": [], "sha": []}
    current, n, low, digest, sep = None, 0, None, None, b""

    def close():
        out["seq"].append(current)
        out["n_end"].append(n)
        out["min_end"].append(low)
        out["sha"].append(digest.hexdigest())

    schema = None
    for batch in batches:
        schema = batch.schema.field("seq").type
        for seq, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if seq != current or digest is None:
                if digest is not None:
                    close()
                current, n, low, digest, sep = seq, 0, conv, hashlib.sha256(), b""
            n += 1
            digest.update(sep + str(conv).encode())
            sep = b","
        if len(out["seq"]) >= 4096:
            yield _batch(out, schema)
            out = {k: [] for k in out}
    if digest is not None:
        close()
    if out["seq"]:
        yield _batch(out, schema)


def _batch(out, seq_type) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(out["seq"], seq_type), pa.array(out["n_end"], pa.int64()),
         pa.array(out["min_end"], pa.int64()), pa.array(out["sha"], pa.string())],
        ["seq", "n_end", "min_end", "ends_sha256"],
    )


def _key(parent: tuple[int, int], t1: int, t2: int) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(
        parent[0].to_bytes(8, "little", signed=True) + parent[1].to_bytes(8, "little", signed=True)
        + t1.to_bytes(8, "little", signed=True) + t2.to_bytes(8, "little", signed=True)
    )
    hi, lo = h >> 64, h & ((1 << 64) - 1)
    return hi - (1 << 64) if hi >= 1 << 63 else hi, lo - (1 << 64) if lo >= 1 << 63 else lo


class TernaryTree:
    """Sequences of ids in a ternary search tree; node 0 is the root (the empty prefix)."""

    def __init__(self):
        self.split = [None]
        self.lo, self.eq, self.hi = [-1], [-1], [-1]
        self.parent, self.depth, self.words = [-1], [0], [0]
        self.key = [(0, 0)]
        self.n_end, self.min_end, self.sha = [0], [None], [None]

    def _new(self, token, parent, words):
        self.split.append(token)
        for a in (self.lo, self.eq, self.hi):
            a.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.words.append(words)
        self.key.append(_key(self.key[parent], *token))
        self.n_end.append(0)
        self.min_end.append(None)
        self.sha.append(None)
        return len(self.split) - 1

    def insert(self, seq, n_end, min_end, sha) -> list[int]:
        """Insert one sequence of (t1, t2, words); returns the nodes of its path."""
        node, path = 0, [0]
        for t1, t2, w in seq:
            token = (t1, t2)
            links, at = self.eq, node
            while True:
                child = links[at]
                if child < 0:
                    child = self._new(token, node, w)
                    links[at] = child
                    break
                if token < self.split[child]:
                    links, at = self.lo, child
                elif token > self.split[child]:
                    links, at = self.hi, child
                else:
                    break
            node = child
            path.append(node)
        self.n_end[node] += n_end
        self.min_end[node] = min_end if self.min_end[node] is None else min(self.min_end[node], min_end)
        self.sha[node] = sha
        return path


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows.extend(zip(*(batch.column(k).to_pylist() for k in range(4))))
    if not rows:
        return
    tree = TernaryTree()
    paths = {}
    # middle first: a balanced tree from sorted input without rotations
    stack = [(0, len(rows))]
    while stack:
        lo, hi = stack.pop()
        if lo >= hi:
            continue
        mid = (lo + hi) // 2
        seq, n_end, min_end, sha = rows[mid]
        path = tree.insert([(s["t1"], s["t2"], s["w"]) for s in seq], n_end, min_end, sha)
        if mid in (0, len(rows) - 1):
            paths[mid] = path
        stack += [(mid + 1, hi), (lo, mid)]
    boundary = set(paths.get(0, [])) | set(paths.get(len(rows) - 1, [])) | {0}
    yield _nodes(tree, boundary)


def _nodes(tree: TernaryTree, boundary: set[int]) -> pa.RecordBatch:
    size = len(tree.split)
    big = None
    members, low, children, leaves, saved = [0] * size, [big] * size, [0] * size, [0] * size, [0] * size
    # sums over a node's siblings in the same binary tree of lo/hi links, itself included
    s_members, s_low, s_count, s_leaves, s_saved = [0] * size, [big] * size, [0] * size, [0] * size, [0] * size
    s_inner, s_inner_leaves, s_inner_saved = [0] * size, [0] * size, [0] * size

    def low_of(a, b):
        return b if a is None else a if b is None else min(a, b)

    for y in range(size - 1, -1, -1):                   # children are always created after parents
        e = tree.eq[y]
        members[y] = tree.n_end[y] + (s_members[e] if e >= 0 else 0)
        low[y] = low_of(tree.min_end[y], s_low[e] if e >= 0 else None)
        children[y] = s_count[e] if e >= 0 else 0
        inner = y not in boundary
        if inner:
            leaves[y] = s_leaves[e] if children[y] else 1
            saved[y] = (members[y] - 1) * tree.words[y] + (s_saved[e] if e >= 0 else 0)
            own_inner, own_leaves, own_saved = 1, leaves[y], saved[y]
        else:                                           # partial: what interior descendants give
            leaves[y] = s_inner_leaves[e] if e >= 0 else 0
            saved[y] = s_inner_saved[e] if e >= 0 else 0
            children[y] = s_inner[e] if e >= 0 else 0
            own_inner, own_leaves, own_saved = 0, leaves[y], saved[y]
        if y == 0:
            continue
        a, b = tree.lo[y], tree.hi[y]
        s_members[y] = members[y] + (s_members[a] if a >= 0 else 0) + (s_members[b] if b >= 0 else 0)
        s_low[y] = low_of(low_of(low[y], s_low[a] if a >= 0 else None), s_low[b] if b >= 0 else None)
        s_count[y] = 1 + (s_count[a] if a >= 0 else 0) + (s_count[b] if b >= 0 else 0)
        s_leaves[y] = leaves[y] + (s_leaves[a] if a >= 0 else 0) + (s_leaves[b] if b >= 0 else 0)
        s_saved[y] = saved[y] + (s_saved[a] if a >= 0 else 0) + (s_saved[b] if b >= 0 else 0)
        s_inner[y] = own_inner + (s_inner[a] if a >= 0 else 0) + (s_inner[b] if b >= 0 else 0)
        s_inner_leaves[y] = own_leaves + (s_inner_leaves[a] if a >= 0 else 0) + (s_inner_leaves[b] if b >= 0 else 0)
        s_inner_saved[y] = own_saved + (s_inner_saved[a] if a >= 0 else 0) + (s_inner_saved[b] if b >= 0 else 0)

    cols = {name: [] for name in (
        "kind", "key1", "key2", "pkey1", "pkey2", "depth", "n_convs", "conv_id", "n_children", "n_leaves",
        "saved_tokens", "words", "ends_sha256", "parent_conv_id", "parent_boundary", "anc1", "anc2")}
    for y in range(size):
        p = tree.parent[y]
        inner = y not in boundary
        cols["kind"].append("i" if inner else "b")
        cols["key1"].append(tree.key[y][0])
        cols["key2"].append(tree.key[y][1])
        cols["pkey1"].append(tree.key[p][0] if p >= 0 else None)
        cols["pkey2"].append(tree.key[p][1] if p >= 0 else None)
        cols["depth"].append(tree.depth[y])
        cols["n_convs"].append(members[y])
        cols["conv_id"].append(low[y])
        cols["n_children"].append(children[y])
        cols["n_leaves"].append(leaves[y])
        cols["saved_tokens"].append(saved[y])
        cols["words"].append(tree.words[y])
        cols["ends_sha256"].append(tree.sha[y])
        parent_boundary = p >= 0 and p in boundary
        cols["parent_conv_id"].append(low[p] if p >= 0 and not parent_boundary else None)
        cols["parent_boundary"].append(parent_boundary)
        ancestors = []
        if not inner:
            z = y
            while z >= 0:
                ancestors.append(tree.key[z])
                z = tree.parent[z]
        cols["anc1"].append([k[0] for k in ancestors] if not inner else None)
        cols["anc2"].append([k[1] for k in ancestors] if not inner else None)
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
             pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(),
             pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), types)], list(cols))


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the prefix tree of the rebuilt conversations (see ``rebuilt``).

    A node is a distinct sequence of the first d rebuilt turns (role, text), the root (d=0)
    included; its members are the conversations that start with it (turnless ones belong to
    the root). Columns: conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves (childless nodes in its subtree, itself included),
    saved_tokens (over its subtree, each node's (n_convs - 1) times the words of its last
    turn's text), ends_sha256 (sha256 of the ascending ids of members with exactly d turns,
    joined by ','; none: the hash of the empty string). Null role or text counts as empty,
    rows without conv_id are left out, repeated turn rows are turns each. An empty table
    has no root: no rows. Extra columns are not carried. Turn ids are 96-bit content hashes.
    """
    spark = conversations.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    convs = rebuilt(conversations.select("conv_id", "turn", "role", "text"))
    # written once: the range partitioner samples its input, which would otherwise run the
    # rebuild and the stream again; distinct sequences of ids are far smaller than the texts
    ends = written(
        convs.select("seq", "conv_id").repartition(shards, "seq").sortWithinPartitions("seq", "conv_id")
        .mapInArrow(_ends, "seq array<struct<t1:long,t2:long,w:long>>, n_end long, min_end long, ends_sha256 string")
    )
    nodes = ends.repartitionByRange(shards, "seq").sortWithinPartitions("seq").mapInArrow(_shard, NODE_SCHEMA)
    inner = nodes.filter("kind = 'i'")
    partial = nodes.filter("kind = 'b'")
    merged = partial.groupBy("key1", "key2").agg(
        F.first("pkey1").alias("pkey1"), F.first("pkey2").alias("pkey2"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"),
        F.sum("saved_tokens").alias("inner_saved"), F.first("words").alias("words"),
        F.max("ends_sha256").alias("ends_sha256"), F.first("anc1").alias("anc1"), F.first("anc2").alias("anc2"),
    )
    edge_children = merged.groupBy(F.col("pkey1").alias("key1"), F.col("pkey2").alias("key2")).agg(
        F.count(F.lit(1)).alias("edge_children")
    )
    merged = merged.join(edge_children, ["key1", "key2"], "left").withColumn(
        "n_children", F.col("inner_children") + F.coalesce("edge_children", F.lit(0))
    )
    own = merged.select(
        F.explode(F.arrays_zip("anc1", "anc2")).alias("a"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"),
        F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("words")).otherwise(0).alias("own_saved"),
    )
    below = own.groupBy(F.col("a.anc1").alias("key1"), F.col("a.anc2").alias("key2")).agg(
        F.sum("leaf").alias("edge_leaves"), F.sum("own_saved").alias("edge_saved")
    )
    lows = merged.select(F.col("key1").alias("pkey1"), F.col("key2").alias("pkey2"), F.col("conv_id").alias("plow"))
    boundary = (
        merged.join(below, ["key1", "key2"])
        .join(lows, ["pkey1", "pkey2"], "left")
        .select(
            "conv_id", "depth", F.col("plow").alias("parent_conv_id"), "n_convs", "n_children",
            (F.col("inner_leaves") + F.col("edge_leaves")).alias("n_leaves"),
            (F.col("inner_saved") + F.col("edge_saved")).alias("saved_tokens"), "ends_sha256",
        )
    )
    linked = inner.join(lows, ["pkey1", "pkey2"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "plow").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
    return linked.unionByName(boundary).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))
    )


def brute_force(rows: list[tuple]) -> list[tuple]:
    """The same nodes from plain dictionaries: rows are (conv_id, turn, role, text)."""
    import zlib

    turns: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c in turns:
        turns[c] = [(r, t) for _, _, r, t in sorted(turns[c])]
    seqs = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(__import__("math").fmod(c, 20))
        seqs[c] = turns.get(base, [])[:h] + turns[c][h:]
    nodes: dict[tuple, list[int]] = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [q for q in nodes if len(q) >= len(prefix) and q[: len(prefix)] == prefix]
        kids = [q for q in below if len(q) == len(prefix) + 1]
        leaves = sum(1 for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below))
        saved = sum((len(nodes[q]) - 1) * len(__import__("re").findall(WORDS, q[-1][1])) for q in below if q)
        ends = sorted(c for c in members if len(seqs[c]) == len(prefix))
        parent = min(nodes[prefix[:-1]]) if prefix else None
        out.append((min(members), len(prefix), parent, len(members), len(kids), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out
