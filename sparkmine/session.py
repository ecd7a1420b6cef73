"""Session factory and the durable cut points shared by multi-pass operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# AQE picks join strategies and splits skewed join partitions from real shuffle sizes;
# UTC keeps every epoch/date function independent of the host.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    # Word-count state grows with the vocabulary: keep it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_spark(app_name: str = "sparkmine", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session. The master comes from spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder on this machine; on a cluster an
    unset directory is an error, because executors could not read it back.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sparkmine-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and return the stored rows.

    Used where several branches must see the same partitioning or where a small
    aggregate of a large input is read more than once. Survives executor loss.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
