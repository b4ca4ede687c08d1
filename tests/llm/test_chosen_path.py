"""The join moves few texts and does not branch where pivots connect a node."""

from __future__ import annotations

import random

from stocklens.llm import chosen_path


def test_a_tight_group_is_connected_before_it_branches(spark, monkeypatch):
    r = random.Random(9)
    base = [f"w{r.randrange(400)}" for _ in range(200)]
    texts = []
    for k in range(40):
        copy = list(base)
        copy[r.randrange(len(copy))] = f"x{k}"
        texts.append((k, " ".join(copy)))
    branched = []
    children = chosen_path._children
    monkeypatch.setattr(
        chosen_path, "_children", lambda *a: branched.append(1) or children(*a)
    )
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = chosen_path.near_duplicates(docs, words=3, percent=85, leaf=8).collect()
    assert {row.component_id for row in got} == {0} and len(got) == 40
    assert not branched


def test_the_id_filter_keeps_the_pool_and_little_else(spark):
    pool = spark.range(0, 20_000, 1000).withColumnRenamed("id", "rep")
    rows = spark.range(-1, 20_000).withColumnRenamed("id", "doc_id")
    found = {r.doc_id for r in chosen_path._likely(rows, "doc_id", pool, "rep").collect()}
    assert {r.rep for r in pool.collect()} <= found and len(found) < 40
