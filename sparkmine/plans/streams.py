"""Streaming jobs run over the present files, and what they have written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions import text as X
from sparkmine.plans.bayes import ORACLE as BAYES_ORACLE
from sparkmine.plans.bayes import entity_model, entity_predictions
from sparkmine.plans.registry import registrar
from sparkmine.plans.text import SQL_PAGE_COUNTS
from sparkmine.session import checkpoint_root
from sparkmine.sources.tables import table, table_path
from sparkmine.streaming import scoring, words

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)


def _folders(spark: SparkSession) -> tuple[str, str]:
    """Output and progress folder of one run, in the shared checkpoint folder."""
    base = f"{checkpoint_root(spark)}/streams/{uuid.uuid4()}"
    return f"{base}/output", f"{base}/progress"


@query(SQL_PAGE_COUNTS)
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of web pages kept by a stateful stream."""
    output, progress = _folders(spark)
    pages = words.read_table(spark, table_path(sf_dir, "pages"), table(spark, sf_dir, "pages"))
    cores = spark.sparkContext.defaultParallelism
    words.count_words(pages.select("html"), X.words(X.cleaned_web_text("html")), output, progress, cores).awaitTermination()
    return words.current_counts(spark, output)


@query(BAYES_ORACLE["nb_entity_predict"])
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests (documents) classified by a stream with per-entity models."""
    output, progress = _folders(spark)
    model = entity_model(spark, sf_dir)
    requests = words.read_table(spark, table_path(sf_dir, "documents"), table(spark, sf_dir, "documents"))
    named = requests.select("doc_id", F.col("source").alias("entity"), "text")
    scoring.score_requests(named, lambda batch: entity_predictions(batch, model), output, progress).awaitTermination()
    scored = scoring.scored_requests(spark, output, "doc_id bigint, entity string, predicted string, score double")
    return scored.withColumn("score", F.round("score", 4))
