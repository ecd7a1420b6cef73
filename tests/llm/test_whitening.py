"""Whitening against a dense eigenvalue solver, and the qd solver alone."""

import math

import numpy as np
import pytest

from sparkmine.llm import whitening


def _expected(rows, components=16):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    longest = max((len(v) for _, v in kept), default=0)
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in kept if len(v) == longest]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=float)
    n, mean = len(fit), fit.mean(axis=0)
    cov = (fit - mean).T @ (fit - mean) / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    return kept, fit, values[:k], vectors[:, :k], np.trace(cov)


def _check(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = whitening.whiten(df).collect()
    kept, fit, values, vectors, trace = _expected(rows)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    assert len(got) == len(kept) * len(values)
    assert {row.n for row in got} == {n} and max(row.identity_error for row in got) < 1e-9
    table = {}
    for i, x in kept:
        table.setdefault(i, (sum((n * a - s) ** 2 for a, s in zip(x, sums)), (np.array(x) - fit.mean(axis=0)) @ vectors / np.sqrt(values)))
    signs = {}
    for row in got:
        deviation, z = table[row.vec_id]
        assert row.deviation == deviation
        assert row.explained == pytest.approx(values[row.component - 1] / trace, rel=1e-9)
        expected = z[row.component - 1]
        assert abs(row.whitened) == pytest.approx(abs(expected), abs=1e-7)
        if abs(expected) > 1e-6:
            assert signs.setdefault(row.component, np.sign(row.whitened * expected)) == np.sign(row.whitened * expected)


def test_whiten_against_eigh(spark):
    rng = np.random.default_rng(3)
    scales = np.linspace(3, 0.2, 20)
    rows = [(i, (rng.normal(size=20) * scales).tolist()) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(1000, 1100)]  # a hot vector
    rows += [(7, rows[5][1]), (None, rows[9][1])]
    rows += [(2000, None), (2001, []), (2002, [float("nan")] * 20), (2003, [1.0] * 19 + [None]), (2004, [1.0] * 19 + [float("-inf")]), (2005, [1.0])]
    _check(spark, [r for r in rows if r != (7, rows[5][1])])
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).where("vec_id = 7").count() == 32


def test_constant_and_dependent_dimensions(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 3))
    rows = [(i, [*(float(math.floor(64 * v)) / 64 for v in b), 2.0, float(math.floor(64 * b[0])) / 64]) for i, b in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = whitening.whiten(df).toPandas()
    assert set(got["component"]) == {1, 2, 3} and got["identity_error"].max() < 1e-9
    assert got.groupby("component")["explained"].first().sum() == pytest.approx(1)


def test_edges_of_whitening(spark):
    schema = "vec_id string, embedding array<float>, x int, r double, component int, n bigint"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    one = [("a", [1.0, 2.0], 1, None, 1, 1), ("b", [1.0, 2.0], 1, 1.0, 1, 1), ("c", None, None, None, None, None)]
    assert whitening.whiten(spark.createDataFrame(one, schema)).count() == 0  # no variance, no component
    far = [("a", [1e30, 0.0], 1, 1.0, 1, 1), ("b", [-1e30, 1.0], 1, 1.0, 1, 1), ("c", [0.0, 5.0], 1, 1.0, 1, 1)]
    got = whitening.whiten(spark.createDataFrame(far, schema)).toPandas()
    assert got["deviation"].isna().any() and got["identity_error"].max() < 1e-4


@pytest.mark.parametrize("kind", ["plain", "graded", "reversed", "equal", "integers", "deficient"])
def test_qd_solver(kind):
    rng = np.random.default_rng(11)
    for _ in range(8):
        d = int(rng.integers(2, 40))
        a = rng.normal(size=(3 * d, d))
        if kind == "graded":
            a = a * np.logspace(0, -9, d)
        elif kind == "reversed":
            a = a * np.logspace(-6, 0, d)
        elif kind == "equal":
            a = np.linalg.qr(a)[0]
        elif kind == "integers":
            a = rng.integers(-2, 3, size=(3 * d, d)).astype(float)
        elif kind == "deficient":
            a[:, 0] = 0
        r = np.linalg.qr(a, mode="r")
        diagonal, upper, v = whitening.bidiagonal(r)
        assert np.allclose(v.T @ v, np.eye(d), atol=1e-12)
        expected = np.linalg.svd(r, compute_uv=False) ** 2
        assert np.allclose(whitening.qd_values(diagonal, upper), expected, rtol=1e-9, atol=1e-14 * expected[0])
        values, directions, _ = whitening.leading(r, 3 * d, 16)
        assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-12
        cov = a.T @ a / (3 * d)
        assert np.abs(cov @ directions - directions * values).max() < 1e-12 * np.abs(cov).max()


def test_factors_are_reduced_in_groups(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    fit = whitening.integer_vectors(df).select("x").distinct().repartition(40)
    x = np.array([r["x"] for r in fit.collect()], dtype=float)
    r = whitening._reduced(fit, len(x), [int(s) for s in x.sum(axis=0)])
    centred = x - x.mean(axis=0)
    assert np.allclose(r.T @ r, centred.T @ centred)
