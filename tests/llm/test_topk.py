"""Exact top-k against brute force, with ties, unusable vectors and several blocks."""

from __future__ import annotations

import numpy as np
import pytest

from featurekit.llm import topk

KIND = "vec_id long, embedding array<float>, label int"


def plain(rows, k=5):
    v = {}
    for i, e, _ in rows:
        if i is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        v.setdefault(i, []).append([int(np.floor(256 * float(np.float32(x)))) for x in e])
    out = []
    for q in sorted(i for i in v if i % 50 == 0):
        scores = []
        for c, many in v.items():
            if c != q:
                scores += [(-sum(a * b for a, b in zip(v[q][0], e)), c) for e in many]
        out += [(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return out


def result(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    found = topk.top_k(df.where("vec_id % 50 = 0"), df)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


@pytest.mark.parametrize("spread", [1.0, 0.002])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, spread, 6).astype(np.float32)], 0) for i in range(500)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)]  # one common vector
    assert result(spark, rows) == plain(rows)


def test_lists_are_not_always_read_to_their_end():
    rng = np.random.default_rng(0)
    rows = np.zeros((4000, 4), np.int64)
    rows[:, 0] = rng.integers(0, 1000, 4000)
    got = {q: (b.tolist(), s.tolist()) for q, b, s in topk.nra_top(np.array([[1, 0, 0, 0]]), np.array([-1]), rows, np.arange(4000), 5)}
    order = np.lexsort((np.arange(4000), -rows[:, 0]))[:5]
    assert got == {0: (order.tolist(), rows[order, 0].tolist())}


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (50, [0.5], None), (100, None, 1), (150, [nan, 1.0], 1), (1, [inf, 0.0], 1), (2, [1.0, None], 1),
        (3, [], 1), (4, [-1.0, 0.25], 1), (4, [-1.0, 0.25], 1), (None, [9.0, 9.0], 1), (5, [1e3, -1e3, 1e3], 1),
    ]
    assert result(spark, rows) == plain(rows)
    assert result(spark, []) == []
    assert result(spark, [(0, [1.0], 1)]) == []


def test_large_components_stay_exact(spark):
    rows = [(50 * i, [float(2**20 + i), float(i)], 0) for i in range(8)] + [(1, [1e8, 1.0], 0)]
    assert result(spark, rows) == plain(rows)
