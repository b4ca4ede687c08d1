"""op11: the threshold algorithm against every distance, and the clustering against a plain loop."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from stocklens.llm.centroids import centroid_digest, exact_nearest, kmeans, nearest


@pytest.mark.parametrize("seed", range(6))
def test_threshold_walk_finds_the_nearest_with_ties(seed):
    r = np.random.default_rng(seed)
    width = 64 if seed < 3 else 5
    centroids = r.integers(-3, 4, (16, width))
    centroids[5] = centroids[2]                       # a tie everywhere: the smaller number wins
    values = np.vstack([r.integers(-4, 5, (500, width)), centroids[[2, 5, 0]]])
    label, dist, computed = nearest(values, centroids)
    want_label, want_dist = exact_nearest(values, centroids)
    assert (label == want_label).all() and (dist == want_dist).all()
    assert computed <= len(values) * len(centroids)


def test_the_walk_prunes_on_clustered_vectors():
    r = np.random.default_rng(9)
    centroids = r.integers(-500, 500, (16, 64))
    values = centroids[r.integers(0, 16, 2000)] + r.integers(-3, 4, (2000, 64))
    _, _, computed = nearest(values, centroids)
    assert computed < 0.5 * len(values) * 16


def plain(rows, clusters=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(c))) for c in e]) for i, e in rows
            if e is not None and len(e) == 64 and all(c is not None and np.isfinite(c) for c in e)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:clusters]
    cents = [list(x) for _, x in start]

    def assign():
        out = []
        for i, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cents]
            out.append((i, x, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for k in range(len(cents)):
            members = [x for _, x, c, _ in got if c == k]
            if members:
                cents[k] = [sum(col) // len(members) for col in zip(*members)]
    got = assign()
    per = {}
    for _, _, c, d in got:
        per[c] = per.get(c, 0) + d
    total = sum(per.values())
    return [(i, c, d, per[c], total, centroid_digest(cents[c])) for i, _, c, d in got]


def test_kmeans_against_a_plain_loop_with_odd_rows(spark):
    r = np.random.default_rng(3)
    rows = [(k, [float(v) for v in r.normal(0, 1, 64)]) for k in range(120)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (200, None), (201, [1.0] * 63), (202, [float("nan")] + [0.0] * 63),
             (203, [None] + [0.0] * 63), (204, [float("inf")] + [0.0] * 63), (205, [0.0] * 64)]
    df = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, label string, x int")
    got = [tuple(row) for row in kmeans(df).collect()]

    def key(t):
        return (t[0] is None, t[0] or 0, t[1:])

    want = plain(rows)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_kmeans_few_and_no_vectors(spark):
    few = spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64), (3, None)], "vec_id long, embedding array<float>")
    got = kmeans(few).collect()
    assert sorted(r.vec_id for r in got) == [1, 2] and all(r.distance == 0 and r.inertia == 0 for r in got)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert kmeans(empty).count() == 0
