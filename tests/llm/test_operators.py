"""Each operator against a brute-force version on small hand-made tables, with the odd cases."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocklens.llm.bpe import Encoder, encoded, read_ranks
from stocklens.llm.chosen_path import near_duplicates
from stocklens.llm.components import connected_components
from stocklens.llm.cover_tree import similar_vectors
from stocklens.llm.packing import pack
from stocklens.llm.quality import QualityModel, fit_quality, quality
from stocklens.llm.redirects import url_verdicts
from stocklens.llm.shared import fold, table
from stocklens.llm.templates import main_text, parse_page
from stocklens.llm.toxicity import fit_toxicity, maximal_segments, toxicity
from stocklens.llm.voronoi import top_inner_products
from stocklens.llm.warc import archived, merge_runs

vocabularies = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.01"
EXTRA = ", node string, rep string, n string"
ODD = [None, "", " ", "one", "one two", "x " * 30_000]


def documents(spark, texts):
    rows = [(k, t, "a", "b", "c") for k, t in enumerate(texts)] + [(None, "no id here at all", "a", "b", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string" + EXTRA)


def vectors(spark, values):
    rows = [(k, v, "a", "b", "c") for k, v in enumerate(values)] + [(None, [1.0, 2.0], "a", "b", "c")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>" + EXTRA)


def components(nodes, linked):
    label = {k: k for k in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("leaf", [1024, 8])
def test_near_duplicates(spark, leaf):
    r = random.Random(4)
    words = [f"w{k}" for k in range(500)]
    base = [r.choice(words) for _ in range(120)]
    texts = list(ODD)
    for _ in range(60):
        copy = list(base)
        for _ in range(r.randrange(9)):
            copy[r.randrange(len(copy))] = r.choice(words)
        texts.append(" ".join(copy))
    texts += [" ".join(r.choice(words) for _ in range(50)) for _ in range(30)] + ["One  TWO", texts[8]]
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    linked = [
        (a, b) for b in range(len(sets)) for a in range(b)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    label = components(range(len(texts)), linked)
    got = near_duplicates(documents(spark, texts), words=3, percent=85, leaf=leaf).collect()
    assert len(got) == len(texts) + 1
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert row.n_shingles == len(sets[row.doc_id])
            assert (row.component_id, row.kept) == (label[row.doc_id], label[row.doc_id] == row.doc_id)


def test_similar_vectors_and_top_products(spark):
    r = np.random.RandomState(0)
    centres = r.normal(size=(6, 12))
    values = [list(map(float, centres[k % 6] + r.normal(scale=0.12, size=12))) for k in range(400)]
    values[7], values[9] = list(values[8]), [0.0] * 12
    odd = [None, [], [float("nan")] * 12, [float("inf")] + [1.0] * 11, [1.0, None]]
    every = values + odd
    good = [k for k, v in enumerate(values) if any(v)]
    u = {k: np.array(values[k]) / np.linalg.norm(values[k]) for k in good}
    linked = [(a, b) for b in good for a in good if a < b and u[a] @ u[b] >= 0.9]
    label = components(range(len(every)), linked)
    links = {k: sum(k in p for p in linked) for k in range(len(every))}
    got = similar_vectors(vectors(spark, every), block_rows=64).collect()
    assert len(got) == len(every) + 1
    for row in got:
        if row.vec_id is not None:
            assert (row.n_links, row.component_id) == (links[row.vec_id], label[row.vec_id]), row
    x = {k: np.floor(64 * np.array(v)).astype(int) for k, v in enumerate(values)}
    best = top_inner_products(vectors(spark, every), F.col("vec_id") % 20 == 0, block_rows=64, query_rows=4)
    found = {}
    for row in best.collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    for q in range(0, 400, 20):
        want = sorted(((int(x[q] @ x[k]), k) for k in x if k != q), key=lambda p: (-p[0], p[1]))[:20]
        assert sorted(found[q]) == [(i + 1, k, s) for i, (s, k) in enumerate(want)]


@pytest.mark.parametrize("copies", [2, 30])
def test_top_products_of_repeated_rows(spark, copies):
    r = np.random.RandomState(1)
    rows = [(k, list(map(float, r.normal(size=6)))) for k in range(200)]
    rows += [rows[k] for k in (0, 3, 8, 20)] * (copies - 1) + [(5, rows[9][1])]
    x = [(k, np.floor(64 * np.array(v)).astype(int)) for k, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for row in top_inner_products(df, F.col("vec_id") % 20 == 0, block_rows=16, query_rows=4).collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    for q in range(0, 200, 20):
        pairs = [(int(a @ b), k) for j, a in x if j == q for k, b in x if k != q]
        want = sorted(pairs, key=lambda p: (-p[0], p[1]))[:20]
        assert sorted(found[q]) == [(i + 1, k, s) for i, (s, k) in enumerate(want)]


def test_encoding_equals_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN
    ranks = read_ranks(path)
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(2)
    texts = [*ODD, "it's  two   spaces \n\n here", "é漢字 <|endoftext|>"] + [
        "".join(r.choice("ab thein'sll 12 \n\té漢_.,!") for _ in range(60)) for _ in range(200)
    ]
    for row in encoded(documents(spark, texts), path, pattern).filter("doc_id is not null").collect():
        text = texts[row.doc_id] or ""
        ids = np.array(known.encode_ordinary(text), "<u4").tobytes()
        assert row.n_tokens == len(ids) // 4 and row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    encoder, tokens = Encoder(ranks, pattern), list(ranks)
    for text in ["a\n \nb", "a\n b", "\t x", "x \t", "a  b", "a \u00a0b", " a", "a ", "\n \n", "x\u3000 y z"]:
        assert encoder.encode(text) == encoder.encode_chunk(text)          # cuts never change pieces
        assert encoder.encode(text) == np.array(known.encode_ordinary(text), "<u4").tobytes()
    for _ in range(2000):
        data = b"".join(r.choice(tokens) for _ in range(r.randrange(1, 5)))
        assert encoder.encode_piece(data) == known._encode_single_piece(data)


def test_main_text(spark):
    page = (
        "<head><title>t</title></head><nav>menu</nav><article><h1>A &amp; B</h1><p>one<b>two\n three<br>x"
        "<p>four</p><div class='comments'>no</div></article><footer>f</footer>"
    )
    blocks, _ = parse_page(page)
    assert " ".join(t for t, _ in blocks) == "A & B onetwo three x four"
    shared = "<div><p>Hosted by us</p></div>"
    rows = [(k, "http://h.example/x", f"<body>{shared}<p>own {k}</p>") for k in range(8)]
    rows += [(90, None, None), (91, "x", ""), (92, "http://other.example/", f"<body>{shared}")]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{k: f"own {k}" for k in range(8)}, 90: "", 91: "", 92: "Hosted by us"}


def test_text_beside_an_article(spark):
    pages = [
        (k, "http://h.example/x", f"<body><div><p>Hosted by us</p></div><article><p>all share</p></article><p>part {k}</p>")
        for k in range(8)
    ]
    got = main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {k: f"all share part {k}" for k in range(8)}


def test_copies_are_no_template_and_hosts_of_any_size_have_them(spark):
    copy = "<body><div><p>first words of a copy</p><p>second</p></div>"
    pages = [(k, "http://copies.example/x", copy) for k in range(6)]
    line = "<p>call us</p>"
    for k in range(10, 610):
        pages.append((k, "http://hot.example/x", f"<body>{line if k < 16 else ''}<p>page number {k}</p>"))
    got = main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    want = dict.fromkeys(range(6), "first words of a copy second")
    assert {r.page_id: r.text for r in got} == want | {k: f"page number {k}" for k in range(10, 610)}


def test_verdicts_reach_aliases(spark):
    link = "<link href='{}' rel='canonical'>"
    rows = [
        (1, "http://bad.example/x", None), (2, "http://a.example/1", link.format("http://bad.example/x#top")),
        (3, "http://A.example/2?q", link.format("/1")), (4, "http://good.example/y", link.format("http://a.example/1")),
        (5, None, ""), (6, "nothing", "<meta http-equiv='refresh' content='0; url=//bad.example/x'>"),
        (7, "http://c.example/p/q", "<meta http-equiv='refresh' content='0; url=r'>"), (8, "http://c.example/p/r", link.format("//bad.example/x")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = (("block", "bad.example", "/"), ("allow", "good.example", "/"))
    blocked = {r.page_id for r in url_verdicts(pages.filter("page_id <> 4"), rules).filter("verdict = 'block'").collect()}
    assert blocked == {1, 2, 3, 7, 8}
    freed = {r.page_id for r in url_verdicts(pages, rules).filter("verdict = 'block'").collect()}
    assert freed == {1}  # one alias is allowed by name; a rule of its own still holds


def test_archives_round_trip(spark):
    html = ["a\r\n\r\nb", "", None, "é" * 50, "a\r\n\r\nb", "WARC/1.1\r\n", "x" * 200_000]
    rows = [(k, f"http://s{k % 2}.example/{k}", h) for k, h in enumerate(html)]
    got = archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    first = {}
    for k, h in enumerate(html):
        first.setdefault(h or "", k)
    assert [(r.url_key, r.captured, r.page_id) for r in got] == sorted((r.url_key, r.captured, r.page_id) for r in got)
    assert len(got) == len(html)
    for r in got:
        data = (html[r.page_id] or "").encode()
        origin = first[html[r.page_id] or ""]
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if origin == r.page_id else ("revisit", origin))


@pytest.mark.parametrize("k", range(1, 8))
def test_loser_tree(k):
    r = random.Random(k)
    runs = [sorted((str(r.randrange(9)), "", r.randrange(9), "", 0) for _ in range(r.randrange(6))) for _ in range(k)]
    assert list(merge_runs(runs)) == sorted(e for run in runs for e in run)


def test_packing_keeps_every_word(spark):
    r = random.Random(1)
    texts = ODD + ["w " * r.randrange(300) for _ in range(300)]
    got = pack(documents(spark, texts), capacities=(64, 128, 256), shard_pieces=100).toPandas()
    words = {k: len((t or "").split()) for k, t in enumerate(texts)}
    assert got[got.doc_id.notna()].groupby("doc_id").length.sum().to_dict() == words
    for _, rows in got.groupby("bin_id"):
        rows = rows.sort_values(["bin_offset", "length"])
        assert rows.length.sum() == rows.bin_fill.iloc[0] <= rows.capacity.iloc[0]
        assert (rows.bin_offset == rows.length.cumsum() - rows.length).all()
        assert rows.capacity.iloc[0] == 64 or rows.capacity.iloc[0] // 2 < rows.bin_fill.iloc[0]
    full = got.drop_duplicates("bin_id")
    assert full.bin_fill.sum() / full.capacity.sum() > 0.9


def test_maximal_segments():
    assert maximal_segments([None, 2.0, None, 3.0, None, None, None, None, 1.0], -1.0) == [(1, 3, 4.0), (8, 8, 1.0)]
    assert maximal_segments([], -1.0) == [] and maximal_segments([None], -1.0) == []


def test_classifiers_on_held_out_rows(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    model = fit_toxicity(docs, labels, is_training=fold(F.col("doc_id"), 3) != 1)
    held = labels.filter(fold(F.col("doc_id"), 3) == 1).select("doc_id", "toxic")
    rows = toxicity(docs, model).join(held, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    odd = toxicity(documents(spark, ODD), model).collect()
    assert len(odd) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in odd)
    trained = fit_quality(docs, labels, is_training=fold(F.col("doc_id"), 5) != 0)
    held = labels.filter(fold(F.col("doc_id"), 5) == 0).select("doc_id", F.col("quality").alias("y"))
    rows = quality(docs, trained).join(held, "doc_id").collect()
    assert sum(r.predicted == r.y for r in rows) >= 0.95 * len(rows)
    assert len(quality(documents(spark, ODD), trained).collect()) == len(ODD) + 1
    empty = labels.limit(0)
    assert fit_toxicity(docs, empty, is_training=F.lit(True)).weights == {}
    assert isinstance(fit_quality(docs, empty, is_training=F.lit(True)), QualityModel)


def test_empty_tables(spark):
    docs = documents(spark, []).limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert near_duplicates(docs).count() == 0 and pack(docs).count() == 0
    assert similar_vectors(vectors(spark, []).limit(0)).count() == 0
    assert top_inner_products(vectors(spark, []).limit(0), F.lit(True)).count() == 0
    assert main_text(pages).count() == 0 and url_verdicts(pages, ()).count() == 0 and archived(pages).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, DATA, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == corpus_pipeline.COLUMNS, name
    left = docs.select("doc_id").distinct().count()
    assert docs.count() == left and before // 2 < left < before


def test_pairs_of_blocks_of_vectors_are_not_shuffled(spark, tmp_path):
    from stocklens.llm import cover_tree

    r = np.random.RandomState(2)
    rows = [(k, [float(x) for x in r.normal(size=8)]) for k in range(300)]
    # a block is written once, and never holds more than a dealt cell does
    blocks = cover_tree._blocks(spark.createDataFrame(rows, "vec_id long, x array<float>"), 64)
    assert sorted(k for b in blocks.collect() for k in (x.vec_id for x in b.rows)) == list(range(300))
    assert blocks.schema["rows"].dataType.elementType["x"].dataType.simpleString() == "array<float>"
    plans = []
    kept = cover_tree.written
    cover_tree.written = lambda df: plans.append(df._jdf.queryExecution().toString()) or kept(df)
    try:
        cover_tree._pairs(blocks, 0.9)
    finally:
        cover_tree.written = kept
    assert "CartesianProduct" in plans[0] and "Exchange" not in plans[0].split("== Physical Plan ==")[1]


def test_blocks_of_vectors_carry_their_tree(spark):
    from stocklens.llm import cover_tree

    r = np.random.RandomState(3)
    centres = r.normal(size=(4, 8))
    rows = [(k, [float(x) for x in centres[k % 4] + r.normal(scale=0.1, size=8)]) for k in range(900)]
    blocks = cover_tree._blocks(spark.createDataFrame(rows, "vec_id long, x array<double>"), 2048).collect()
    inner = 0
    for b in blocks:
        units = cover_tree._units(np.array([v.x for v in b.rows]))
        stack = [cover_tree._runs(units, zip(b.sizes, b.radii, b.below, strict=True))]
        assert (stack[0].first, stack[0].end) == (0, len(units))
        while stack:
            run = stack.pop()
            assert (run.centre == units[run.first]).all()
            assert np.sqrt(((units[run.rows] - run.centre) ** 2).sum(1)).max() <= run.radius + 1e-12
            if run.children:
                inner += 1
                ends = [run.first, *(c.end for c in run.children)]
                assert [c.first for c in run.children] == ends[:-1] and ends[-1] == run.end
                stack += run.children
    assert inner > 0


@pytest.mark.parametrize("spread", [0.0, 0.02, 0.15])
def test_links_of_leaves_equal_brute_force(spread):
    from stocklens.llm import cover_tree as ct

    r = np.random.RandomState(4)
    x = r.normal(size=(1, 16)) + r.normal(scale=spread, size=(500, 16)) if spread else np.ones((500, 16))
    units = ct._units(x)
    parts = [np.arange(0, 300), np.arange(300, 500)]
    blocks = [ct.Block(units[p], p, ct.Run(units[p[0]], 2.0, 0, len(p))) for p in parts]
    counts, pairs = np.zeros(500, int), [(0, 0), (0, 1), (1, 1)]
    edges = set()
    for a, b in pairs:
        found = ct._dual((str(a), str(b)), [blocks[a], blocks[b]], 0.98, float(np.sqrt(0.04)))
        for block, place, n, one, other in zip(*(c.to_pylist() for c in found.columns), strict=True):
            if one is None:
                counts[parts[int(block)][place]] += n
            else:
                edges.add((one, other))
    want = units @ units.T >= 0.98
    np.fill_diagonal(want, False)
    assert (counts == want.sum(1)).all()
    linked = [(a, b) for a, b in zip(*np.nonzero(np.triu(want)), strict=True)]
    assert components(range(500), edges) == components(range(500), linked)
