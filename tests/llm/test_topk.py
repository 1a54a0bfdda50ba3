"""Nearest neighbours against all scores."""

import math
import random

import numpy as np
import pytest

from accessaudit.llm import topk


def brute(rows, k=5, every=50):
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in usable]
    best = {}
    for q, a in ints:
        if q % every == 0:
            for c, b in ints:
                if c != q and len(a) == len(b):
                    score = sum(x * y for x, y in zip(a, b, strict=True))
                    best[q, c] = max(score, best.get((q, c), score))
    out = []
    for q in {q for q, _ in best}:
        ranked = sorted((-s, c) for (p, c), s in best.items() if p == q)[:k]
        out += [(q, r, c, -s) for r, (s, c) in enumerate(ranked, 1)]
    return sorted(out)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, block string")
    got = sorted(tuple(r) for r in topk.nearest(df, **kw).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, **kw)


def some(n, d=20, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) for _ in range(d)]) for i in range(n)]


def test_against_all_scores(spark):
    rows = some(260)
    rows += [(300 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(50, rows[7][1]), rows[3], rows[3], (None, rows[1][1]), (400, None), (450, [math.nan] * 20), (500, [math.inf] + [0.0] * 19)]
    rows += [(550, [None] * 20), (600, [1.0, 2.0]), (601, [1.0, 3.0]), (650, []), (651, []), (700, [0.0] * 20)]
    random.Random(2).shuffle(rows)
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], some(1), some(3), [(1, [1.0])]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_blocks_and_pruning_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "DIMENSIONS", 3)
    check(spark, some(120, 16, 3), k=3, every=10)


def test_large_components_stay_exact():
    rng = np.random.default_rng(1)
    q, c = rng.integers(-(1 << 31), 1 << 31, (3, 2)), rng.integers(-(1 << 31), 1 << 31, (2, 40))
    got = topk.search(np.arange(3), q, np.arange(100, 140), c, 4)
    for i in range(3):
        scores = sorted((-sum(int(q[i, d]) * int(c[d, j]) for d in range(2)), 100 + j) for j in range(40))[:4]
        assert [(-int(s), int(n)) for m, n, s in zip(*got, strict=True) if m == i] == scores
