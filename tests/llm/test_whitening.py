"""Whitening against numpy's eigenvectors of the covariance."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accessaudit.llm import whitening as w
from accessaudit.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"
NAMES = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def brute(vectors, k=8):
    """vec_ids, whitened values, deviations, shares and n of vectors that take part."""
    rows = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([r[1] for r in rows], float)
    n, sums = len(rows), [sum(r[1][j] for r in rows) for j in range(x.shape[1])]
    centred = x - np.array(sums) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(r[1], sums, strict=True)) for r in rows]
    return [r[0] for r in rows], centred @ turn / np.sqrt(values), deviations, values / (centred**2).sum() * n, n


def compared(found, vectors, tolerance=1e-6):
    ids, white, deviations, shares, n = brute(vectors)
    k = white.shape[1]
    assert Counter((r["vec_id"], r["component"], r["deviation"], r["n"]) for r in found) == Counter((i, c + 1, d, n) for i, d in zip(ids, deviations, strict=True) for c in range(k))
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["deviation"], r["component"]), []).append(r["whitened"])
    for c in range(k):
        mine = [(by[(i, d, c + 1)][0], x) for i, d, x in zip(ids, deviations, white[:, c], strict=True)]
        got, want = np.array(mine).T
        sign = np.sign(got @ want)
        assert np.abs(got - sign * want).max() < tolerance
        assert abs(next(r["explained"] for r in found if r["component"] == c + 1) / shares[c] - 1) < 1e-9
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9


def test_the_query(spark, data):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    compared(QUERIES["op11_whitening"](spark, data).collect(), vectors)


def test_rows_of_every_kind(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.standard_normal(12).tolist()) for i in range(80)]
    vectors += [(3, vectors[5][1]), (3, vectors[5][1]), (None, rng.standard_normal(12).tolist())]
    bad = [(90, None), (91, [None] * 12), (92, [math.nan] * 12), (93, [math.inf] + [0.0] * 11), (94, [1e30] * 12), (95, []), (96, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(vectors + bad, SCHEMA).withColumns({c: F.lit("own") for c in ("n", "x", "dimensions", "ids", "rows", "component")})
    compared([r for r in w.whitened(table).collect()], vectors)


def test_too_few_rows(spark):
    for vectors in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert w.whitened(spark.createDataFrame(vectors, SCHEMA)).collect() == []


def test_fewer_components_than_asked(spark):
    vectors = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]
    found = w.whitened(spark.createDataFrame(vectors, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 20
    assert abs(found[0]["explained"] - 1) < 1e-9


def test_lengths_have_fits_of_their_own(spark):
    rng = np.random.default_rng(2)
    short, long_ = ([(i, rng.standard_normal(d).tolist()) for i in range(a, b)] for d, a, b in ((4, 0, 30), (9, 30, 70)))
    found = w.whitened(spark.createDataFrame(short + long_, SCHEMA)).collect()
    compared([r for r in found if r["vec_id"] < 30], short)
    compared([r for r in found if r["vec_id"] >= 30], long_)


def spectrum(values, seed=0):
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return turn, (turn * np.array(values)) @ turn.T


@pytest.mark.parametrize(
    "values",
    [
        [1000.0 / (i + 1) for i in range(200)],
        [100.0] * 3 + [99.99] * 4 + [1.0] * 150,
        [1.0] * 100,
        [0.0] * 60,
        [5.0, 4.0] + [0.0] * 90,
        [1e12] + [1.0 - i / 1000 for i in range(120)],
        [10 + 1e-3 * i for i in range(90, 0, -1)],
        [3.0, 2.0, 1.0],
    ],
)
def test_spectra(values):
    turn, v = spectrum(values)
    passes = []

    def product(q):
        passes.append(1)
        return v @ q

    found, q = w.leading(product, len(values), min(8, len(values)))
    top = sorted(values, reverse=True)[:8]
    assert np.allclose(found, top, rtol=1e-9, atol=1e-9 * max(top))
    assert np.abs(v @ q - q * found).max() <= 1e-9 * max(max(top), 1e-300)
    assert np.allclose(q.T @ q, np.eye(len(top)), atol=1e-12)
    assert len(passes) < 400


def test_the_filter_is_the_polynomial():
    values = np.linspace(0, 10, 50)
    grown = w.filtered(lambda q: values[:, None] * q, np.ones((50, 1)), values[:, None], 0.0, 6.0, 10.0)[:, 0]
    chebyshev = np.polynomial.chebyshev.Chebyshev.basis(w.DEGREE)
    assert np.allclose(grown, chebyshev((values - 3) / 3) / chebyshev(7 / 3))


def test_sums_and_deviations_are_exact():
    rows = np.array([[2**50, 5], [2**50 + 3, -7], [2**50 - 10, 11]], np.int64)
    center = w.Center(3, [int(x) for x in rows.astype(object).sum(axis=0)])
    want = [sum((3 * int(x) - s) ** 2 for x, s in zip(row, center.sums, strict=True)) for row in rows]
    assert center.deviations(rows) == want
    wide = np.array([[0, 0], [2**40, 1]], np.int64)
    assert w.Center(2, [2**40, 1]).deviations(wide) == [None, None]
    assert np.allclose(center.centred(rows).sum(axis=0), 0)
