"""op12: ternary search trees per range shard against a plain prefix dictionary."""

from __future__ import annotations

import random

import pytest

from stocklens.llm.prefix_trie import brute_force, prefix_trie


def conversation_rows():
    r = random.Random(8)
    texts = ["hi", "hello there", "", None, "how are you", "x " * 5000, "fine\tthanks", "bye"]
    rows = []
    for c in list(range(0, 120)) + [200, 205, 219, 240, 241, -3, -20, -23]:
        for turn in range(r.randrange(0, 6)):
            rows.append((c, turn if r.random() > 0.05 else None, r.choice(["user", "assistant", None]),
                         r.choice(texts[:3]) if turn < 2 else r.choice(texts)))
    rows += [(7, 1, "user", "hi"), (7, 1, "user", "hi"), (None, 1, "user", "lost"), (300, None, None, None)]
    for c in range(400, 460):                                  # one very common conversation
        rows += [(c, 0, "user", "hi"), (c, 1, "assistant", "hello there"), (c, 2, "user", "how are you")]
    return rows


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_prefix_trie_matches_brute_force(spark, shards):
    rows = conversation_rows()
    df = spark.createDataFrame([(*row, "x", 1) for row in rows],
                               "conv_id long, turn long, role string, text string, seq string, key1 int")
    got = sorted(tuple(r) for r in prefix_trie(df, shards=shards).fillna(-1, ["parent_conv_id"]).collect())
    want = sorted(tuple(-1 if v is None else v for v in row) for row in brute_force(rows))
    assert got == want


def test_prefix_trie_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(empty).count() == 0
