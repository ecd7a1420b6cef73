import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from sparkmine.operators import logistic as G


def _rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.gauss(3, 2), rng.gauss(100, 30)
        rows.append((i, a, b, 7.0, int(0.8 * a - 0.03 * b + rng.gauss(0, 1.5) > 0)))
    return rows


@pytest.mark.parametrize("reg", [0.0, 0.1, 2.0])
def test_same_optimum_as_library(spark, reg):
    df = spark.createDataFrame(_rows(1), "id long, a double, b double, c double, y int")
    model = G.fit_logistic(df, ["a", "b", "c"], "y", reg)
    library = LogisticRegression(regParam=reg, maxIter=500, tol=1e-13, labelCol="y").fit(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))
    assert model.coefficients == pytest.approx(list(library.coefficients), rel=1e-5, abs=1e-8)
    assert model.intercept == pytest.approx(library.intercept, rel=1e-5)
    assert model.coefficients[2] == 0 and model.steps < 15


def test_rows_without_a_feature_stay(spark):
    rows = [*_rows(2), (900, None, 1.0, 7.0, 1), (901, 1.0, float("nan"), 7.0, 0), (902, 1.0, 1.0, None, None), (903, 1.0, 1.0, 7.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int")
    model = G.fit_logistic(df, ["a", "b", "c"], "y")
    without = G.fit_logistic(df.where("id < 900"), ["a", "b", "c"], "y")
    assert model.coefficients == pytest.approx(without.coefficients) and model.intercept == pytest.approx(without.intercept)
    scored = {r["id"]: r for r in model.score(df).collect()}
    assert len(scored) == len(rows)
    assert all(scored[i]["p1"] is None and scored[i]["prediction"] is None for i in (900, 901, 902)) and scored[903]["p1"] is not None


def test_threshold_is_exclusive(spark):
    model = G.Logistic(("x",), (1.0,), 0.0, 1, 0.0, threshold=0.5)
    got = model.score(spark.createDataFrame([(0.0,), (0.1,), (-0.1,)], "x double")).orderBy("x").collect()
    assert [r["prediction"] for r in got] == [0.0, 0.0, 1.0]


def test_no_optimum_is_an_error(spark):
    df = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "x double, y int")
    with pytest.raises(ValueError, match="settle"):
        G.fit_logistic(df, ["x"], "y", reg_param=0.0, max_steps=20)
    assert G.fit_logistic(df, ["x"], "y", reg_param=0.1).coefficients[0] > 0
    with pytest.raises(ValueError, match="no labelled row"):
        G.fit_logistic(df.where("x > 100"), ["x"], "y")


def test_odds_table(spark):
    rows = G.odds_table(G.Logistic(("a", "b"), (0.5, -1.0), 0.0, 1, 0.0), spark).collect()
    assert [round(r["odds_ratio"], 6) for r in rows] == [1.648721, 0.367879] and round(rows[1]["percent_change"], 4) == -63.2121
