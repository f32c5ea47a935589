from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from rivermill.llm import topk

SCHEMA = "vec_id long, embedding array<double>, ids string, norm string"


def brute(rows, queries, k, scale=64):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(scale * x) for x in v]

    usable = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for q, v in queries:
        w = whole(v)
        if q is None or w is None:
            continue
        others = list(usable)
        others.remove((q, w))  # itself, once
        scored = sorted((-sum(a * b for a, b in zip(w, c)), i) for i, c in others)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k, **setting):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.search(df, df.filter("vec_id % 20 = 0"), k, **setting).collect())


@pytest.mark.parametrize("setting", [{}, {"shard": 60, "pivots": 7}])
def test_equals_brute_force(spark, monkeypatch, setting):
    monkeypatch.setattr(topk, "CELL", 60)
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "PAGE", 40)
    rng = random.Random(1)
    centers = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centers)]) for i in range(700)]
    rows += [(i, rows[0][1]) for i in range(700, 1000)]  # a vector that a third of all rows share
    assert run(spark, rows, 10, **setting) == brute(rows, [r for r in rows if r[0] % 20 == 0], 10)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (20, [1.0, 2.0, 0.0]),
        (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, []), (7, [-0.0, 0.0]), (None, [9.0, 9.0]), (8, [1.0]), (40, [2.0**24, -3.0, 7.5]),
        (9, [-1e6, 1e6, 3.0]), (60, None),
    ]
    assert run(spark, rows, 20) == brute(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], 20)
    assert run(spark, [], 20) == [] and run(spark, [(0, [1.0])], 20) == []


def test_repeated_queries(spark):
    """Rows of one id are queries of their own, and candidates of each other."""
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [5.0, -1.0]), (1, [3.0, 3.0]), (2, [0.0, 1.0]), (40, [5.0, -1.0])]
    assert run(spark, rows, 3) == brute(rows, [r for r in rows if r[0] % 20 == 0], 3)


def test_ties_and_large_components(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(300)]
    assert run(spark, rows, 7, scale=1) == brute(rows, [r for r in rows if r[0] % 20 == 0], 7, scale=1)
    rows = [(i, [rng.uniform(-(2.0**24), 2.0**24) for _ in range(4)]) for i in range(120)]
    assert run(spark, rows, 5) == brute(rows, [r for r in rows if r[0] % 20 == 0], 5)


def test_bounds_leave_pages_out():
    rng = np.random.default_rng(2)
    rows = np.floor(64 * (rng.normal(size=(6000, 3)) + 8 * rng.integers(0, 5, size=(6000, 1))))
    most = float((rows**2).sum(axis=1).max())
    lifted = topk._lifted(rows, most)
    center = lifted[:1]
    asked = np.arange(0, 6000, 500)
    block = topk.Block(asked, asked, rows[asked], np.full(len(asked), math.inf), center, most, 5)
    for members, away in topk.pages(lifted, 64):
        ids = pa.array([[int(m)] for m in members], pa.list_(pa.int64()))
        block.look(0, float(topk.distances(lifted[members[:1]], center[0])[0]), away, rows[members], ids)
    got = sorted(zip(*(c.tolist() for c in block.best())))
    want = []
    for q in asked.tolist():
        scored = sorted(((-int(rows[i] @ rows[q]), i) for i in range(6000) if i != q))[:5]
        want += [(q, q, i, -s) for s, i in scored]
    assert got == sorted(want)
    assert block.computed < 0.5 * len(asked) * 6000
