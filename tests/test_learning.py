import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from sparkmine.operators import learning as ML


@pytest.fixture(scope="module")
def exam(spark):
    rng = random.Random(8)
    rows = []
    for i in range(160):
        a, b = rng.choice([2.0, 3.0, 3.5, 4.0, 4.5, 5.0]), rng.choice([2.0, 3.0, 4.0, 5.0])
        rows.append((i, a, b, int(a + b + rng.gauss(0, 1) > 7)))
    return spark.createDataFrame(rows, "id long, a double, b double, passed int").repartition(4)


@pytest.fixture(scope="module")
def logistic(exam):
    model = ML.fit_logistic(exam, ["a", "b"], "passed")
    return model, model.stages[-1]


def test_probabilities_follow_from_coefficients(exam, logistic):
    model, last = logistic
    terms = dict(zip(["a", "b"], map(float, last.coefficients)))
    rows = model.transform(exam).withColumns(ML.logit_columns(terms, last.intercept))
    rows = rows.withColumns({"p": vector_to_array("probability"), "raw": vector_to_array("rawPrediction"), "top": ML.class_probability()})
    for r in rows.collect():
        assert r["p1"] == pytest.approx(r["p"][1]) and r["p0"] == pytest.approx(r["p"][0]) and r["logit"] == pytest.approx(r["raw"][1])
        assert r["top"] == max(r["p"])


def test_odds_ratios_scale_with_the_unit(spark, logistic):
    rows = {r["feature"]: r for r in ML.odds_ratios(logistic[1], ["a", "b"], spark, {"b": 10}).collect()}
    assert rows["a"]["odds_ratio"] == pytest.approx(math.exp(rows["a"]["coef"]))
    assert rows["b"]["logit_change"] == pytest.approx(10 * rows["b"]["coef"])
    assert rows["b"]["percent_change"] == pytest.approx((math.exp(10 * rows["b"]["coef"]) - 1) * 100)


def test_best_threshold_equals_library_summary(exam, logistic):
    model, last = logistic
    tuned, best = ML.with_best_threshold(last, model.transform(exam), "passed")
    library = last.summary.fMeasureByThreshold.collect()
    top = max(r["F-Measure"] for r in library)
    assert best.first()["f_measure"] == pytest.approx(top)
    assert tuned.getThreshold() == pytest.approx(max(r["threshold"] for r in library if r["F-Measure"] == top))
    rows = tuned.transform(model.stages[0].transform(exam)).select(vector_to_array("probability")[1].alias("p"), "prediction").collect()
    assert all((r["p"] > tuned.getThreshold()) == (r["prediction"] == 1.0) for r in rows if abs(r["p"] - tuned.getThreshold()) > 1e-9)


def test_registered_function_equals_native(spark):
    ML.register_max_element(spark)
    df = spark.createDataFrame([(Vectors.dense([0.2, 0.8]),), (SparseVector(3, [1], [0.5]),)], ["v"])
    rows = df.select(F.call_udf("max_vector_element", F.col("v")).alias("u"), ML.class_probability("v").alias("n")).collect()
    assert [(r["u"], r["n"]) for r in rows] == [(0.8, 0.8), (0.5, 0.5)]
    null = spark.sql("SELECT 1 AS x").select(F.call_udf("max_vector_element", F.lit(None)).alias("u")).first()
    assert null["u"] is None


def test_one_hot_keeps_a_place_for_unseen(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "k string")
    model = Pipeline(stages=ML.one_hot_stages(["k"])).fit(df)
    assert model.transform(df).first()["k_vec"].size == 3
    unseen = model.transform(spark.createDataFrame([("z",)], "k string")).first()["k_vec"]
    assert unseen.toArray().tolist() == [0.0, 0.0, 0.0]


def test_feature_columns(exam):
    assert ML.feature_columns(exam, ["id", "passed"]) == ["a", "b"]
    assert ML.feature_columns(exam.withColumn("s", F.lit("x")), ["id"], numeric_only=False) == ["a", "b", "passed", "s"]


def test_pipeline_expands_merges_and_leaves_the_estimator_alone(spark):
    df = spark.createDataFrame([(float(t), math.sin(t), 1 + 2 * t + 0.5 * t * t + 3 * math.sin(t)) for t in range(60)], "t double, w double, y double")
    estimator = LinearRegression(maxIter=50, regParam=0.0)
    model = ML.linear_pipeline(["t"], "y", degree=2, extra=["w"], estimator=estimator).fit(df)
    assert model.stages[-1].coefficients.toArray().tolist() == pytest.approx([2.0, 0.5, 3.0], abs=1e-6)
    assert not estimator.isSet("labelCol") and estimator.getFeaturesCol() == "features"
    summary = ML.fit_summary(model.stages[-1], spark).first()
    assert summary["r2"] == pytest.approx(1.0) and summary["intercept"] == pytest.approx(1.0, abs=1e-5)
    rows = ML.true_and_predicted(model, df, ["t"], "y", 10, 12).collect()
    assert sorted(r["position"] for r in rows) == [10, 11] and all(r["y"] == pytest.approx(r["prediction"]) for r in rows)
    parts = ML.train_test_metrics(model, {"train": df.where("t < 40"), "test": df.where("t >= 40")}, "y").collect()
    assert {r["part"]: r["n"] for r in parts} == {"train": 40, "test": 20}


def test_comparison_survives_a_failing_algorithm(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(40)], "x double, y double")
    estimators = {"line": LinearRegression(), "tree": DecisionTreeRegressor(), "broken": DecisionTreeRegressor(maxBins=2, maxDepth=31)}
    table, models = ML.compare_regressors(df, df, ["x"], "y", estimators)
    rows = table.collect()
    assert rows[0]["algorithm"] == "line" and rows[-1]["algorithm"] == "broken" and rows[-1]["error"]
    assert set(models) == {"line", "tree"}


def test_cross_validation_is_repeatable(spark, exam):
    frame = ML.assembler(["a", "b"]).transform(exam)
    model = LogisticRegression(labelCol="passed", maxIter=10)
    grid = ParamGridBuilder().addGrid(model.regParam, [0.01, 0.5]).build()
    evaluator = MulticlassClassificationEvaluator(labelCol="passed", metricName="f1")
    first = ML.cross_validate(model, grid, evaluator, frame, "id", 3, seed=5)
    second = ML.cross_validate(model, grid, evaluator, frame.repartition(1), "id", 3, seed=5)
    assert first.avgMetrics == pytest.approx(second.avgMetrics)
    report = ML.grid_report(first, spark).collect()
    assert len(report) == 2 and sum(r["best"] for r in report) >= 1
    assert {r["params"]["LogisticRegression.regParam"] for r in report} == {"0.01", "0.5"}
    empty = ML.cross_validate(model, ParamGridBuilder().build(), evaluator, frame, "id", 3, seed=5)
    assert len(empty.avgMetrics) == 1


def test_importances_and_margin_classifier(spark, exam):
    rows = ML.importances(SparseVector(4, [1, 3], [0.25, 0.75]), ["w", "x", "y", "z"], spark, 1).collect()
    assert [tuple(r) for r in rows] == [("z", 0.75)]
    frame = ML.assembler(["a", "b"]).transform(exam).withColumn("label", F.least(F.floor(F.col("a") - 2), F.lit(2)).cast("double"))
    predicted = ML.one_vs_rest_svm("label", max_iter=5).fit(frame).transform(frame)
    assert {r["prediction"] for r in predicted.select("prediction").distinct().collect()} <= {0.0, 1.0, 2.0}


def test_label_text(spark):
    df = spark.createDataFrame([(1.0,), (0.0,)], "prediction double").select(ML.label_text("prediction", "yes", "no").alias("r"))
    assert [r["r"] for r in df.collect()] == ["yes", "no"]


def test_grid_score_keeps_documents_with_a_null_feature(spark, tmp_path):
    from sparkmine.plans import learning as plans

    text = F.expr("repeat('word and ', 1 + cast(id % 7 as int))")
    documents = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), text.alias("text"), F.when(F.col("id") > 1, 10 * (F.col("id") % 9)).alias("n_chars"))
    documents.withColumn("text", F.when(F.col("doc_id") != 2, F.col("text"))).write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(30).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality")).write.parquet(str(tmp_path / "labels.parquet"))
    rows = {r.doc_id: r for r in plans.grid_score(spark, str(tmp_path)).collect()}
    assert sorted(rows) == list(range(40))
    empty = {i for i, r in rows.items() if None in (r.chars, r.words, r.word_length)}
    assert {0, 1} <= empty and empty == {i for i, r in rows.items() if r.result is None}


def test_bayes_grid_equals_the_library_cross_validation(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, StringIndexer

    from sparkmine.operators import bayes_grid as NB
    from sparkmine.operators.sampling import hash_split
    from sparkmine.operators.text import doc_terms

    rng = random.Random(4)
    weights = {"a": (60, 30, 16, 8, 4, 2, 1), "b": (60, 20, 20, 5, 5, 3, 3), "c": (60, 30, 10, 12, 2, 4, 1)}
    rows = [(i, c, rng.choices("tuvwxyz", weights[c], k=rng.randrange(0, 25))) for i, c in enumerate(rng.choices("abc", (5, 3, 2), k=400))]
    docs = spark.createDataFrame(rows, "doc_id long, label string, tokens array<string>").repartition(4)
    bag, bayes = CountVectorizer(inputCol="tokens", outputCol="features", minDF=2), NaiveBayes(labelCol="index", featuresCol="features")
    grid = ParamGridBuilder().addGrid(bag.vocabSize, [2, 4, 100]).addGrid(bayes.modelType, ["multinomial", "gaussian"]).build()
    estimator = Pipeline(stages=[StringIndexer(inputCol="label", outputCol="index"), bag, bayes])
    evaluator = MulticlassClassificationEvaluator(labelCol="index", metricName="f1")
    model = ML.cross_validate(estimator, grid, evaluator, docs, "doc_id", folds=3, seed=11)
    expected = {tuple(sorted(r["params"].items())): r["avg_metric"] for r in ML.grid_report(model, spark).collect()}
    folded = hash_split(docs, "doc_id", {str(i): 1.0 for i in range(3)}, 11, "fold").withColumn("fold", F.col("fold").cast("int"))
    bags = doc_terms(folded, ["doc_id", "label", "fold"], F.col("tokens"), outer=True)
    found = NB.cross_validated(bags, folded, 3, [2, 4, 100]).collect()
    got = {(("CountVectorizer.vocabSize", str(r["size"])), ("NaiveBayes.modelType", r["kind"])): r["avg_f1"] for r in found}
    assert got == pytest.approx(expected, abs=1e-12) and len(got) == 6


def test_bayes_grid_needs_no_arrow_setting_of_the_session(spark, tmp_path):
    """A driver's session may leave ``spark.sql.execution.arrow.pyspark.enabled`` at its default."""
    from sparkmine.plans import learning as plans

    words = {"en": "the cat and the dog", "de": "der hund und die katze", "fr": "le chien et le chat"}
    rows = [(i, lang, f"{text} {text.split()[i % 5]}") for i, (lang, text) in enumerate([*words.items()] * 20)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    told, key = [], "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key)
    try:
        for enabled in ("false", "true"):
            spark.conf.set(key, enabled)
            told.append(sorted((sorted(r["params"].items()), r["avg_metric"], r["best"]) for r in plans.nb_grid_cv(spark, str(tmp_path)).collect()))
    finally:
        spark.conf.set(key, before)
    assert told[0] == told[1] and len(told[0]) == 8 and max(metric for _, metric, _ in told[0]) > 0.9
