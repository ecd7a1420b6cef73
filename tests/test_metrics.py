import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from sparkmine.operators import metrics as M


@pytest.fixture(scope="module")
def classified(spark):
    rng = random.Random(1)
    rows = [(float(rng.randrange(4)), float(rng.choice([0, 1, 2, 5]))) for _ in range(300)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_weighted_metrics_equal_library(classified):
    row = M.weighted_metrics(classified, "label", "prediction").first()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    names = {
        "accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1",
        "weighted_fpr": "weightedFalsePositiveRate",
    }
    for ours, theirs in names.items():
        assert row[ours] == pytest.approx(evaluator.setMetricName(theirs).evaluate(classified)), ours


def test_macro_metrics_count_undefined_as_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (2, 1), (3, 3), (3, 3)], "y int, z int")
    row = M.macro_metrics(df, "y", "z").first()
    assert row["accuracy"] == pytest.approx(5 / 6)
    assert row["precision"] == pytest.approx((2 / 3 + 1 + 1) / 3) and row["recall"] == pytest.approx((1 + 0.5 + 1) / 3)
    assert row["f1_score"] == pytest.approx((0.8 + 2 / 3 + 1) / 3)
    never = spark.createDataFrame([("a", "b"), ("a", "a")], "y string, z string")
    assert M.macro_metrics(never, "y", "z").first()["recall"] == pytest.approx(0.25)


def test_report_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (2, 1), (3, 3), (3, 3)], "y int, z int")
    rows = {r["class"]: r for r in M.report_with_averages(df, "y", "z").collect()}
    assert set(rows) == {"1", "2", "3", "macro avg", "weighted avg"}
    assert rows["1"]["precision"] == pytest.approx(2 / 3) and rows["2"]["support"] == 2 and rows["macro avg"]["support"] == 6


def test_regression_metrics_equal_library(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.gauss(5, 2), rng.gauss(5, 1)) for _ in range(200)], "label double, prediction double")
    row = M.regression_metrics(df, "label").first()
    for name in ("rmse", "mse", "mae", "r2"):
        assert row[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "label double, prediction double")
    assert M.regression_metrics(constant, "label").first()["r2"] is None


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(400)]
    return spark.createDataFrame(rows, "score double, y int").repartition(6)


def test_roc_is_monotone_and_auc_equals_library(scored):
    points = [(r["fpr"], r["tpr"]) for r in M.roc_points(scored, "score", "y").collect()]
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    assert all(a[0] <= b[0] and a[1] <= b[1] for a, b in zip(points, points[1:]))
    library = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    assert M.auc(scored, "score", "y").first()["auc"] == pytest.approx(library.evaluate(scored))


def test_best_threshold_is_a_true_maximum(scored):
    rows = scored.collect()

    def f_at(t):
        tp = sum(r["y"] for r in rows if r["score"] >= t)
        chosen, positives = sum(r["score"] >= t for r in rows), sum(r["y"] for r in rows)
        return 2 * tp / (chosen + positives)

    measures = M.fmeasure_by_threshold(scored, "score", "y")
    best = M.best_threshold(measures).first()
    thresholds = {r["score"] for r in rows}
    assert best["f_measure"] == pytest.approx(max(f_at(t) for t in thresholds))
    assert best["threshold"] == max(t for t in thresholds if f_at(t) == pytest.approx(best["f_measure"], abs=1e-12))
    assert measures.count() == len(thresholds)


def test_one_class_only_has_no_auc(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, y int")
    assert M.auc(df, "score", "y").first()["auc"] is None
    assert M.roc_points(df, "score", "y").where(F.col("fpr") > 0).count() == 1


def test_regression_metrics_skip_rows_without_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0), (50.0, None), (None, 4.0)], "label double, prediction double")
    row = M.regression_metrics(df, "label").first()
    assert (row.n, row.mse, row.mae, row.r2) == (2, 0.5, 0.5, 0.5)
