"""Evaluation metrics as aggregates: one pass over the predictions per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.ordering import with_running_sums
from sparkmine.session import durable


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """n, mse, rmse, mae and r2 over the rows that have both label and prediction, for the table or per group."""
    y, error = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction)
    mse = F.avg(error * error)
    spread = F.var_pop(F.when(error.isNotNull(), y))
    return df.groupBy(*by).agg(
        F.count(error).alias("n"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, F.lit(1.0) - mse / spread).alias("r2"),
    )


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_totals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class of ``label`` or ``predicted``: tp, predicted and actual rows."""
    hit = F.when(F.col("label").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0)
    roles = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("tp")),
        F.struct(
            F.col("predicted").alias("class"),
            F.lit(0).cast("bigint").alias("actual"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("tp"),
        ),
    )
    return (
        counts.select(*by, F.inline(roles))
        .groupBy(*by, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("actual").alias("support"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    """0 when the whole is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1 and support per class."""
    totals = class_totals(confusion(df, label, prediction, by), by)
    return totals.select(
        *by,
        "class",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "tp",
        "predicted",
    )


def report_with_averages(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Class rows followed by ``macro avg`` and ``weighted avg`` rows."""
    report = durable(class_report(df, label, prediction)).withColumn("class", F.col("class").cast("string"))
    measures = ["precision", "recall", "f1"]
    macro = report.agg(
        F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support")
    )
    weighted = report.agg(
        F.lit("weighted avg").alias("class"),
        *[_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    columns = ["class", *measures, "support"]
    return report.select(columns).unionByName(macro).unionByName(weighted)


def weighted_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy and support-weighted precision, recall, f1 and false-positive rate."""
    report = class_report(df, label, prediction, by)
    n = F.sum("support")
    # False positives over negatives of a class need the total; both come from class sums.
    shared = report.groupBy(*by).agg(
        n.alias("n"),
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / n).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"),
        F.collect_list(F.struct("tp", "predicted", "support")).alias("__classes"),
    )
    rates = F.transform(
        "__classes", lambda c: c["support"] * F.coalesce(F.try_divide(c["predicted"] - c["tp"], F.col("n") - c["support"]), F.lit(0.0))
    )
    total = F.aggregate(rates, F.lit(0.0), lambda acc, x: acc + x)
    return shared.withColumn("weighted_fpr", total / F.col("n")).drop("__classes")


def macro_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy and class-averaged precision, recall, f1 (0 where undefined)."""
    return (
        class_report(df, label, prediction, by)
        .groupBy(*by)
        .agg(
            (F.sum("tp") / F.sum("support")).alias("accuracy"),
            F.avg("precision").alias("precision"),
            F.avg("recall").alias("recall"),
            F.avg("f1").alias("f1_score"),
        )
    )


def threshold_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, as the threshold ``score >= t``: tp, fp, what the score itself
    adds (d_tp, d_fp), and the totals of positives and negatives."""
    y = F.col(label).cast("bigint")
    grouped = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(F.sum(y).alias("d_tp"), F.sum(1 - y).alias("d_fp"))
    sums = {"tp": F.col("d_tp"), "fp": F.col("d_fp")}
    return with_running_sums(grouped, [F.desc("threshold")], sums, totals=["positives", "negatives"])


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """ROC curve ``(fpr, tpr)`` with both end points."""
    counts = threshold_counts(df, score, label)
    points = counts.select(
        _ratio(F.col("fp"), F.col("negatives")).alias("fpr"), _ratio(F.col("tp"), F.col("positives")).alias("tpr")
    )
    ends = df.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "fpr double, tpr double")
    return points.unionByName(ends).orderBy("fpr", "tpr")


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule."""
    counts = threshold_counts(df, score, label)
    strip = F.col("d_fp").cast("double") * (2 * F.col("tp") - F.col("d_tp")) / 2
    area = F.try_divide(F.sum(strip), F.max(F.col("positives").cast("double") * F.col("negatives")))
    return counts.agg(area.alias("auc"))


def fmeasure_by_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """precision, recall and F-measure at every distinct score."""
    tp, fp, positives = F.col("tp"), F.col("fp"), F.col("positives")
    return threshold_counts(df, score, label).select(
        "threshold",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, positives).alias("recall"),
        _ratio(2 * tp, tp + fp + positives).alias("f_measure"),
    )


def best_threshold(measures: DataFrame) -> DataFrame:
    """The threshold of the largest F-measure (the highest one on ties)."""
    best = F.max(F.struct("f_measure", "threshold"))
    return measures.agg(best.alias("best")).select("best.threshold", "best.f_measure")
