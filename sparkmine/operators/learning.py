"""Iterative models on MLlib pipelines: assembly, encoders, fits, scoring and tuning.

Fits keep only coefficients, trees or vocabularies on the driver; data stays in Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, LogisticRegressionModel, OneVsRest
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.ml.param import Param
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.operators import metrics as M
from sparkmine.operators.ordering import series_slice
from sparkmine.operators.sampling import hash_split
from sparkmine.session import durable

FEATURES = "features"


def feature_columns(df: DataFrame, exclude: Sequence[str] = (), numeric_only: bool = True) -> list[str]:
    """Columns not excluded, numeric ones by default."""
    kept = [f for f in df.schema if f.name not in exclude]
    return [f.name for f in kept if not numeric_only or isinstance(f.dataType, T.NumericType)]


def assembler(columns: Sequence[str], output: str = FEATURES, handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)


def one_hot_stages(columns: Sequence[str]) -> list[Estimator]:
    """Indexer and encoder for many columns; unseen values keep a place of their own."""
    indexes = [f"{c}_index" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexes, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexes, outputCols=[f"{c}_vec" for c in columns], dropLast=True),
    ]


def linear_pipeline(
    features: Sequence[str],
    label: str,
    degree: int = 1,
    extra: Sequence[str] = (),
    handle_invalid: str = "skip",
    estimator: Estimator | None = None,
) -> Pipeline:
    """Assemble, expand to ``degree``, merge ``extra`` columns, fit. The estimator is
    copied, so callers never share a mutated default."""
    stages: list = [assembler(features, "base_features", handle_invalid)]
    current = "base_features"
    if degree > 1:
        stages.append(PolynomialExpansion(degree=degree, inputCol=current, outputCol="poly_features"))
        current = "poly_features"
    if extra:
        stages.append(assembler([current, *extra], "merged_features", handle_invalid))
        current = "merged_features"
    model = (estimator or LinearRegression()).copy()
    return Pipeline(stages=[*stages, model.setLabelCol(label).setFeaturesCol(current)])


def train_test_metrics(model: Transformer, parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Regression metrics per named part, e.g. train and test."""
    scored = None
    for name, df in parts.items():
        part = model.transform(df).select(F.lit(name).alias("part"), F.col(label), F.col("prediction"))
        scored = part if scored is None else scored.unionByName(part)
    return M.regression_metrics(scored, label, by=["part"])


def fit_summary(model: LinearRegressionModel, spark: SparkSession) -> DataFrame:
    """One row: coefficients, intercept, iterations, objective history and errors."""
    s = model.summary
    row = (
        [float(c) for c in model.coefficients], float(model.intercept), int(s.totalIterations),
        [float(x) for x in s.objectiveHistory], float(s.meanSquaredError), float(s.rootMeanSquaredError),
        float(s.meanAbsoluteError), float(s.r2),
    )
    schema = (
        "coefficients array<double>, intercept double, iterations int, objective_history array<double>, "
        "mse double, rmse double, mae double, r2 double"
    )
    return spark.createDataFrame([row], schema)


def inference(model: LinearRegressionModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """``(term, coef, std_err, t, p)`` of an unpenalised normal-equation fit."""
    s = model.summary
    coefs = [*[float(c) for c in model.coefficients], float(model.intercept)]
    stats = zip(s.coefficientStandardErrors, s.tValues, s.pValues)
    rows = [(term, c, float(e), float(t), float(p)) for term, c, (e, t, p) in zip([*features, "const"], coefs, stats)]
    return spark.createDataFrame(rows, "term string, coef double, std_err double, t double, p double")


def compare_regressors(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, estimators: Mapping[str, Estimator], handle_invalid: str = "skip"
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Test metrics per algorithm, best r2 first; a failing algorithm gets an error text."""
    spark, models, rows = train.sparkSession, {}, []
    assembled = assembler(features, handle_invalid=handle_invalid)
    train_rows = durable(assembled.transform(train).select(FEATURES, label))
    test_rows = durable(assembled.transform(test).select(FEATURES, label))
    for name, estimator in estimators.items():
        try:
            fitted = estimator.copy().setLabelCol(label).setFeaturesCol(FEATURES).fit(train_rows)
            found = M.regression_metrics(fitted.transform(test_rows), label).first()
            models[name] = PipelineModel([assembled, fitted])
            rows.append((name, found["r2"], found["rmse"], found["mse"], found["mae"], None))
        except Exception as error:  # noqa: BLE001 - the comparison reports it and goes on
            rows.append((name, None, None, None, None, str(error)[:200]))
    table = spark.createDataFrame(rows, "algorithm string, r2 double, rmse double, mse double, mae double, error string")
    return table.orderBy(F.desc_nulls_last("r2"), "algorithm"), models


def true_and_predicted(model: Transformer, df: DataFrame, order_by: Sequence[str], label: str, start: int = 0, end: int = -1) -> DataFrame:
    """``(position, label, prediction)`` for a range of the ordered rows."""
    scored = model.transform(df).select(*order_by, label, "prediction")
    return series_slice(scored, order_by, start, end)


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, reg_param: float = 0.1, max_iter: int = 100) -> PipelineModel:
    model = LogisticRegression(maxIter=max_iter, regParam=reg_param, elasticNetParam=0.0, featuresCol=FEATURES, labelCol=label)
    return Pipeline(stages=[assembler(features, handle_invalid="skip"), model]).fit(df)


def odds_ratios(model: LogisticRegressionModel, features: Sequence[str], spark: SparkSession, units: Mapping[str, float] | None = None) -> DataFrame:
    """Effect of one unit of every feature (``units`` rescales, e.g. 86400 s to a day)."""
    rows = [(f, float(c), float((units or {}).get(f, 1.0))) for f, c in zip(features, model.coefficients)]
    table = spark.createDataFrame(rows, "feature string, coef double, unit double")
    logit = F.col("coef") * F.col("unit")
    return table.withColumns({"logit_change": logit, "odds_ratio": F.exp(logit), "percent_change": (F.exp(logit) - 1) * 100})


def class_probability(probability: str = "probability") -> Column:
    """Largest element of a probability vector."""
    return F.array_max(vector_to_array(probability))


def register_max_element(spark: SparkSession, name: str = "max_vector_element") -> None:
    """SQL function for the largest element of a vector; NULL for NULL."""
    spark.udf.register(name, lambda v: None if v is None else float(max(v.toArray())), T.DoubleType())


def logit_columns(terms: Mapping[str, float], intercept: float) -> dict[str, Column]:
    """Logit and both probabilities of every row from plain coefficients."""
    logit = F.lit(float(intercept))
    for name, weight in terms.items():
        logit = logit + F.col(name) * F.lit(float(weight))
    p1 = 1 / (1 + F.exp(-logit))
    return {"logit": logit, "p1": p1, "p0": 1 - p1}


def with_best_threshold(model: LogisticRegressionModel, scored: DataFrame, label: str) -> tuple[LogisticRegressionModel, DataFrame]:
    """Copy of the model whose threshold gives the best F-measure on ``scored`` rows."""
    positive = scored.select(vector_to_array("probability")[1].alias("p"), F.col(label))
    best = durable(M.best_threshold(M.fmeasure_by_threshold(positive, "p", label)))
    return model.copy().setThreshold(best.first()["threshold"]), best


def label_text(prediction: str, yes: str, no: str) -> Column:
    return F.expr(f"if({prediction} = 1.0, '{yes}', '{no}')")


def importances(vector: SparseVector, names: Sequence[str], spark: SparkSession, k: int = 20) -> DataFrame:
    """``(term, importance)`` of the ``k`` most important features."""
    sparse = vector if isinstance(vector, SparseVector) else SparseVector(len(vector), list(enumerate(vector)))
    rows = [(names[int(i)], float(v)) for i, v in zip(sparse.indices, sparse.values)]
    return spark.createDataFrame(rows, "term string, importance double").orderBy(F.desc("importance"), "term").limit(k)


def one_vs_rest_svm(label: str, reg_param: float = 1e-3, max_iter: int = 20, parallelism: int = 2) -> OneVsRest:
    """Linear margin classifier for many classes."""
    return OneVsRest(classifier=LinearSVC(regParam=reg_param, maxIter=max_iter), featuresCol=FEATURES, labelCol=label, parallelism=parallelism)


def cross_validate(
    estimator: Estimator, grid: list[dict[Param, object]], evaluator: Evaluator, df: DataFrame, key: str, folds: int, seed: int, parallelism: int = 2
) -> CrossValidatorModel:
    """Cross-validation with folds from a hash of the row key: the same folds on any
    partitioning. The folds are stored once and shared by all fits."""
    weights = {str(i): 1.0 for i in range(folds)}
    folded = durable(hash_split(df, key, weights, seed, "__fold").withColumn("__fold", F.col("__fold").cast("int")))
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="__fold", parallelism=parallelism
    )
    return validator.fit(folded)


def grid_report(model: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """``(params, avg_metric, best)``, keyed by parameter values."""
    grid = model.getEstimatorParamMaps()
    larger = model.getEvaluator().isLargerBetter()
    rows = [
        ({f"{p.parent.split('_')[0]}.{p.name}": str(v) for p, v in params.items()}, float(metric))
        for params, metric in zip(grid, model.avgMetrics)
    ]
    return points_report(rows, spark, larger)


def points_report(points: Sequence[tuple[dict[str, str], float]], spark: SparkSession, larger: bool = True) -> DataFrame:
    """``(params, avg_metric, best)`` of the points of a grid."""
    best = (max if larger else min)(metric for _, metric in points)
    rows = [(params, metric, metric == best) for params, metric in points]
    return spark.createDataFrame(rows, "params map<string,string>, avg_metric double, best boolean")
