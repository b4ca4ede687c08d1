"""op13: anchors at difference-cover positions against every window hashed."""

from __future__ import annotations

import random

import pytest

from stocklens.llm.substrings import brute_force, difference_cover, repeated_windows


@pytest.mark.parametrize("period", [1, 7, 13, 21, 35])
def test_difference_cover_covers(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def texts():
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    out = [None, "", "  \t\n", "one", "a " * 36, "a " * 35, "b " * 100]
    for k in range(40):
        words = [r.choice(vocabulary) for _ in range(r.randrange(20, 200))]
        if k % 3 == 0:
            cut = r.randrange(len(words))
            words[cut:cut] = passage.split()[: r.randrange(30, 60)]
        out.append("\t".join(words) if k % 5 == 0 else " ".join(words))
    out.append(out[10])                                   # a repeated row
    out.append(passage + " " + passage)                   # repeats itself
    out.append(" ".join(f"u{k}" for k in range(50_000)))  # very long, nothing repeated
    out.append(" ".join(f"u{k}" for k in range(100, 140)) + " Ü ü")
    return out


@pytest.mark.parametrize("period", [21, 8])
def test_anchor_dedup_matches_brute_force(spark, period):
    given = texts()
    rows = [(k, t, "x", 1) for k, t in enumerate(given)] + [(None, given[12], "x", 1), (3, given[13], "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rk string, starts int")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, r.n_removed, r.kept_sha256)
                 for r in repeated_windows(df, period=period).collect())
    want = sorted(((i is None, i or 0), *v) for (i, *_), v in zip(rows, brute_force([t for _, t, *_ in rows])))
    assert got == want
    assert any(v[2] > 0 for v in want) and any(v[2] == 0 and v[1] > 35 for v in want)


def test_anchor_dedup_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_windows(empty).count() == 0
