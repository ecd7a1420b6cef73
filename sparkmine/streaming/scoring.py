"""Classification of incoming requests with stored per-entity models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def score_requests(requests: DataFrame, classify: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> StreamingQuery:
    """Classify a stream of requests batch by batch.

    ``classify`` joins a batch with the model tables, which are stored once before the
    stream starts. A repeated batch overwrites its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        classify(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def scored_requests(spark: SparkSession, output: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch bigint").parquet(output).drop("batch")
