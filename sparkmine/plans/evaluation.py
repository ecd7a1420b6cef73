"""Metric reports over predictions made by fixed rules from table columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import metrics as M
from sparkmine.plans.registry import registrar
from sparkmine.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)

MEASURES = ["accuracy", "weighted_precision", "weighted_recall", "f1", "weighted_fpr"]


def _rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    return lines.withColumn("prediction", F.col("l_quantity") * 1500.0)


_REGRESSION_SQL = """
    count(*) AS n, round(avg((l_extendedprice - l_quantity * 1500) ** 2), 4) AS mse,
    round(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 6) AS rmse,
    round(avg(abs(l_extendedprice - l_quantity * 1500)), 6) AS mae,
    round(1 - avg((l_extendedprice - l_quantity * 1500) ** 2) / var_pop(l_extendedprice), 9) AS r2"""


@query(f"SELECT {_REGRESSION_SQL} FROM lineitem")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.regression_metrics(_priced_lines(spark, sf_dir), "l_extendedprice")
    return _rounded(_rounded(_rounded(found, "mse", digits=4), "rmse", "mae", digits=6), "r2")


@query(f"SELECT l_returnflag, {_REGRESSION_SQL} FROM lineitem GROUP BY l_returnflag")
def regression_metrics_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.regression_metrics(_priced_lines(spark, sf_dir), "l_extendedprice", by=["l_returnflag"])
    return _rounded(_rounded(_rounded(found, "mse", digits=4), "rmse", "mae", digits=6), "r2")


# A rule that predicts a priority from the price; its last class never occurs as a label.
_RULE = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "6-NONE"]


def _ruled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice")
    place = F.least(F.floor(F.col("o_totalprice") / 100000), F.lit(len(_RULE) - 1)).cast("int") + 1
    return orders.withColumn("predicted_priority", F.element_at(F.array(*[F.lit(c) for c in _RULE]), place))


_RULE_SQL = "[" + ", ".join(f"'{c}'" for c in _RULE) + "][cast(least(floor(o_totalprice / 100000), 4) AS INTEGER) + 1]"
_CLASS_SQL = f"""
    WITH p AS (SELECT o_orderpriority AS y, {_RULE_SQL} AS z FROM orders),
    c AS (SELECT DISTINCT y AS class FROM p UNION SELECT DISTINCT z FROM p),
    t AS (SELECT class, (SELECT count(*) FROM p WHERE y = class AND z = class) AS tp,
                 (SELECT count(*) FROM p WHERE z = class) AS predicted, (SELECT count(*) FROM p WHERE y = class) AS support FROM c),
    m AS (SELECT class, tp, predicted, support,
                 CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted::DOUBLE END AS "precision",
                 CASE WHEN support = 0 THEN 0 ELSE tp / support::DOUBLE END AS recall,
                 CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support)::DOUBLE END AS f1,
                 (predicted - tp) / nullif((SELECT count(*) FROM p) - support, 0)::DOUBLE AS fpr FROM t)"""


@query(f"""{_CLASS_SQL}
    SELECT cast(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support)::DOUBLE, 9) AS accuracy,
           round(sum("precision" * support) / sum(support), 9) AS weighted_precision,
           round(sum(recall * support) / sum(support), 9) AS weighted_recall,
           round(sum(f1 * support) / sum(support), 9) AS f1, round(sum(fpr * support) / sum(support), 9) AS weighted_fpr FROM m""")
def class_metrics_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(M.weighted_metrics(_ruled_orders(spark, sf_dir), "o_orderpriority", "predicted_priority"), *MEASURES)


@query(f"""{_CLASS_SQL}
    SELECT round(sum(tp) / sum(support)::DOUBLE, 9) AS accuracy, round(avg("precision"), 9) AS "precision",
           round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1_score FROM m""")
def class_metrics_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.macro_metrics(_ruled_orders(spark, sf_dir), "o_orderpriority", "predicted_priority")
    return _rounded(found, "accuracy", "precision", "recall", "f1_score")


@query(f"""{_CLASS_SQL}
    SELECT class, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM m
    UNION ALL SELECT 'macro avg', round(avg("precision"), 9), round(avg(recall), 9), round(avg(f1), 9), cast(sum(support) AS BIGINT) FROM m
    UNION ALL SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
           round(sum(f1 * support) / sum(support), 9), cast(sum(support) AS BIGINT) FROM m""")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.report_with_averages(_ruled_orders(spark, sf_dir), "o_orderpriority", "predicted_priority")
    return _rounded(found, "precision", "recall", "f1")


@query(f"SELECT o_orderpriority AS label, {_RULE_SQL} AS predicted, count(*) AS n FROM orders GROUP BY 1, 2")
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion(_ruled_orders(spark, sf_dir), "o_orderpriority", "predicted_priority")


def _scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with their length as the score of the label."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return documents.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


_ROC_SQL = """
    WITH s AS (SELECT n_chars AS t, sum(quality) AS d_tp, sum(1 - quality) AS d_fp
               FROM documents JOIN labels USING (doc_id) GROUP BY n_chars),
    c AS (SELECT t, sum(d_tp) OVER (ORDER BY t DESC) AS tp, sum(d_fp) OVER (ORDER BY t DESC) AS fp, d_tp, d_fp,
                 sum(d_tp) OVER () AS p, sum(d_fp) OVER () AS n FROM s)"""


@query(f"""{_ROC_SQL}
    SELECT round(fp / n::DOUBLE, 9) AS fpr, round(tp / p::DOUBLE, 9) AS tpr FROM c
    UNION ALL SELECT 0.0, 0.0 UNION ALL SELECT 1.0, 1.0""")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(M.roc_points(_scored_documents(spark, sf_dir), "n_chars", "quality"), "fpr", "tpr")


@query("""
    SELECT round(avg(CASE WHEN a.n_chars > b.n_chars THEN 1.0 WHEN a.n_chars = b.n_chars THEN 0.5 ELSE 0.0 END::DOUBLE), 9) AS auc
    FROM (SELECT n_chars FROM documents JOIN labels USING (doc_id) WHERE quality = 1) a,
         (SELECT n_chars FROM documents JOIN labels USING (doc_id) WHERE quality = 0) b""")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the curve; its SQL counts ordered pairs instead."""
    return _rounded(M.auc(_scored_documents(spark, sf_dir), "n_chars", "quality"), "auc")


_F_SQL = f"""{_ROC_SQL}
    SELECT cast(t AS DOUBLE) AS threshold, round(tp / (tp + fp)::DOUBLE, 9) AS "precision", round(tp / p::DOUBLE, 9) AS recall,
           round(2 * tp / (tp + fp + p)::DOUBLE, 9) AS f_measure FROM c"""


@query(_F_SQL)
def fmeasure_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = M.fmeasure_by_threshold(_scored_documents(spark, sf_dir), "n_chars", "quality")
    return _rounded(measures, "precision", "recall", "f_measure")


@query(f"SELECT threshold, f_measure FROM ({_F_SQL}) ORDER BY f_measure DESC, threshold DESC LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = M.fmeasure_by_threshold(_scored_documents(spark, sf_dir), "n_chars", "quality")
    return M.best_threshold(_rounded(measures, "f_measure"))
