"""A training corpus from raw documents: quality rules, near copies, benchmark leaks, personal data, mixing.

Every stage takes ``(spark, docs, sf_dir)`` and returns all documents that it keeps, with the columns of ``documents``; the last one
adds each copy's training position and orders by it. ``run`` writes every stage to the shared folder and reads it again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmine.llm import decontam, hosts, mixing, parity, pii
from sparkmine.session import checkpoint_root
from sparkmine.sources.tables import table

NEAR = parity.Rule(k=5, num=80, den=100)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not bad ones of a bad host."""
    return hosts.good_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the smallest ``doc_id``."""
    return parity.keep_one(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.redact(docs, pii.train_tagger(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by training position."""
    return mixing.training_order(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]
# The decontamination and personal-data stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the documents of ``sf_dir``."""
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
