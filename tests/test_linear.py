import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from sparkmine.operators import learning as ML
from sparkmine.operators import linear as L


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        x = rng.uniform(-5, 15)
        rows.append((i, "ab"[i % 2], x, 3.0 * x - 0.4 * x * x + rng.gauss(0, 6), rng.gauss(0, 3), 4.0))
    return spark.createDataFrame(rows, "id long, g string, X double, Y double, Z double, C double").repartition(5)


@pytest.mark.parametrize("reg,net", [(0.0, 0.0), (0.3, 0.8), (10.0, 0.8), (2.0, 0.0), (1.0, 1.0)])
def test_fits_equal_library(spark, points, reg, net):
    data = points.withColumns(L.power_columns("X", 3))
    features = ["X", "X2", "X3", "Z", "C"]
    ours = L.linear_fits(L.comoments(data, features, "Y"), len(features), [(reg, net)]).first()
    estimator = LinearRegression(regParam=reg, elasticNetParam=net, maxIter=2000, tol=1e-12, labelCol="Y", featuresCol="features")
    library = estimator.fit(ML.assembler(features).transform(data))
    assert ours["coefficients"] == pytest.approx(library.coefficients.toArray().tolist(), rel=1e-4, abs=1e-5)
    assert ours["intercept"] == pytest.approx(library.intercept, rel=1e-4, abs=1e-5)
    assert ours["mse"] == pytest.approx(library.summary.meanSquaredError, rel=1e-6)
    assert ours["r2"] == pytest.approx(library.summary.r2, rel=1e-6)


def test_one_feature_path_equals_library_and_general_fit(points):
    specs = [0.0, 0.3, 10.0, 50.0]
    path = {r["reg_param"]: r for r in L.elastic_net_path(points, "X", "Y", specs, 0.8).collect()}
    fits = L.linear_fits(L.comoments(points, ["X"], "Y"), 1, [(r, 0.8) for r in specs]).collect()
    for fit in fits:
        row = path[fit["reg_param"]]
        assert row["slope"] == pytest.approx(fit["coefficients"][0], abs=1e-9) and row["intercept"] == pytest.approx(fit["intercept"])
        assert row["mse"] == pytest.approx(fit["mse"]) and row["r2"] == pytest.approx(fit["r2"], abs=1e-9)


def test_groups_are_fitted_apart(points):
    both = {r["g"]: r for r in L.ols_fit(points, "X", "Y", ["g"]).collect()}
    for g in "ab":
        x, y = zip(*[(r["X"], r["Y"]) for r in points.where(F.col("g") == g).collect()])
        slope, intercept = np.polyfit(x, y, 1)
        assert both[g]["slope"] == pytest.approx(slope) and both[g]["intercept"] == pytest.approx(intercept)
    fits = {r["g"]: r for r in L.linear_fits(L.comoments(points, ["X"], "Y", ["g"]), 1, [(0.0, 0.0)], ["g"]).collect()}
    assert fits["a"]["coefficients"][0] == pytest.approx(both["a"]["slope"])


def test_constant_feature_and_label(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 7.0)], "X double, Y double")
    fit = L.linear_fits(L.comoments(df, ["X"], "Y"), 1, [(0.0, 0.0)]).first()
    assert fit["coefficients"] == [0.0] and fit["intercept"] == 6.0
    flat = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "X double, Y double")
    assert L.elastic_net_path(flat, "X", "Y", [1.0], 0.5).first()["slope"] == 0.0


def test_inference_equals_library(spark, points):
    terms = L.inference_terms(points, "X", "Y", ["id"])
    table = {r["term"]: r for r in L.coefficient_table(terms).collect()}
    model = LinearRegression(solver="normal", labelCol="Y", featuresCol="features").fit(ML.assembler(["X"]).transform(points))
    library = {r["term"]: r for r in ML.inference(model, ["x1"], spark).collect()}
    for term in ("x1", "const"):
        for ours, theirs in (("coef", "coef"), ("std_err", "std_err"), ("t", "t"), ("p", "p")):
            assert table[term][ours] == pytest.approx(library[term][theirs], rel=1e-6, abs=1e-12)
        assert table[term]["low"] < table[term]["coef"] < table[term]["high"]


def test_residual_diagnostics_by_hand(points):
    row = L.inference_terms(points, "X", "Y", ["id"]).first()
    data = sorted((r["id"], r["X"], r["Y"]) for r in points.collect())
    x, y = np.array([d[1] for d in data]), np.array([d[2] for d in data])
    slope, intercept = np.polyfit(x, y, 1)
    e = y - slope * x - intercept
    n = len(x)
    assert row["durbin_watson"] == pytest.approx((np.diff(e) ** 2).sum() / (e**2).sum())
    s2 = (e**2).mean()
    assert row["log_likelihood"] == pytest.approx(-n / 2 * (math.log(2 * math.pi * s2) + 1))
    assert row["aic"] == pytest.approx(4 - 2 * row["log_likelihood"])
    assert row["skew"] == pytest.approx((e**3).mean() / s2**1.5) and row["kurtosis"] == pytest.approx((e**4).mean() / s2**2)
    singular = np.linalg.svd(np.column_stack([np.ones(n), x]), compute_uv=False)
    assert row["condition_number"] == pytest.approx(singular[0] / singular[1])
    assert 0 <= row["prob_omnibus"] <= 1


# Two-sided 95 % and 99 % quantiles of Student's t.
@pytest.mark.parametrize("confidence,dof,value", [(0.95, 1, 12.7062), (0.95, 10, 2.22814), (0.95, 98, 1.98447), (0.99, 5, 4.03214)])
def test_t_quantiles(confidence, dof, value):
    assert L.t_critical(confidence, dof) == pytest.approx(value, abs=1e-4)
    assert L.t_probability(value, dof) == pytest.approx(1 - confidence, abs=1e-4)


def test_cross_validation_equals_refits(points):
    data = points.withColumn("fold", F.pmod("id", F.lit(4)).cast("int"))
    features, specs = ["X", "Z"], [(0.0, 0.0), (1.0, 0.5), (5.0, 0.0)]
    found = L.cross_validated_fits(L.comoments(data, features, "Y", ["fold"]), 2, specs).collect()
    for row in found:
        errors = []
        for f in range(4):
            estimator = LinearRegression(
                regParam=row["reg_param"], elasticNetParam=row["elastic_net"], tol=1e-12, maxIter=2000, labelCol="Y", featuresCol="features"
            )
            assembled = ML.assembler(features).transform(data)
            model = estimator.fit(assembled.where(F.col("fold") != f))
            errors.append(model.evaluate(assembled.where(F.col("fold") == f)).rootMeanSquaredError)
        assert row["avg_rmse"] == pytest.approx(np.mean(errors), rel=1e-5)


def test_grid_and_extreme_lines(spark, points):
    grid = L.evaluation_grid(points, "X").orderBy("id").collect()
    xs = [r["X"] for r in points.collect()]
    pad = 0.05 * (max(xs) - min(xs))
    assert [r["X"] for r in grid] == pytest.approx(np.linspace(min(xs) - pad, max(xs) + pad, 100).tolist())
    table = L.coefficient_table(L.inference_terms(points, "X", "Y", ["id"]))
    band = L.extreme_lines(L.evaluation_grid(points, "X"), "X", table)
    fit = L.ols_fit(points, "X", "Y").first()
    line = L.score_linear(band, [F.col("X")], [fit["slope"]], fit["intercept"])
    assert band.where((F.col("y_low") > line) | (F.col("y_high") < line)).count() == 0


def test_power_columns(spark):
    df = spark.createDataFrame([(2.0,)], "X double")
    row = df.select(*[c.alias(n) for n, c in {**L.power_columns("X", 4), **L.squared_columns(["X"])}.items()]).first()
    assert row.asDict() == {"X": 2.0, "X2": 4.0, "X3": 8.0, "X4": 16.0, "X_sq": 4.0}


def test_best_spec_is_tested_on_rows_no_fold_held(spark):
    rng = random.Random(21)
    rows = []
    for i in range(600):
        a, b = rng.gauss(0, 1), rng.gauss(0, 2)
        rows.append((a, b, 3 * a - b + rng.gauss(0, 1), i % 6 - 1))
    df = spark.createDataFrame(rows, "a double, b double, y double, fold int")
    specs = [(5.0, 0.5), (0.0, 0.0), (0.0, 0.0), (1.0, 1.0)]
    got = L.select_and_test(L.comoments(df, ["a", "b"], "y", ["fold"]), 2, specs).collect()
    best = [r for r in got if r["best"]]
    assert len(best) == 1 and best[0]["reg_param"] == 0.0 and all(r["test_rmse"] is None for r in got if not r["best"])
    train, test = np.array([r[:3] for r in rows if r[3] >= 0]), np.array([r[:3] for r in rows if r[3] < 0])
    design = np.column_stack([np.ones(len(train)), train[:, :2]])
    beta = np.linalg.lstsq(design, train[:, 2], rcond=None)[0]
    error = test[:, 2] - beta[0] - test[:, :2] @ beta[1:]
    assert best[0]["test_rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert best[0]["test_r2"] == pytest.approx(1 - (error**2).mean() / test[:, 2].var())
    alone = L.select_and_test(L.comoments(df.where("fold >= 0"), ["a", "b"], "y", ["fold"]), 2, specs).where("best").first()
    assert alone["test_rmse"] is None
