"""Incrementally updated word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmine.operators.text import most_common, word_counts

BATCH_BYTES = 256 << 20


def read_files(
    spark: SparkSession, path: str, like: DataFrame, glob: str = "*.parquet", files_per_batch: int = 1, bytes_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, with the schema of ``like``.

    ``bytes_per_batch`` admits files by their size instead of their number, at least one a batch.
    """
    reader = spark.readStream.schema(like.schema).option("pathGlobFilter", glob)
    if bytes_per_batch is None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame, bytes_per_batch: int = BATCH_BYTES) -> DataFrame:
    """A Parquet table as a stream, whether ``path`` is one file or a folder of part files."""
    # A streamed path must be a folder unless it is a pattern: this one matches the path alone.
    return read_files(spark, f"{path[:-1]}[{path[-1]}]", like, "*", bytes_per_batch=bytes_per_batch)


def count_words(texts: DataFrame, items: Column, output: str, checkpoint: str, tasks: int | None = None) -> StreamingQuery:
    """Count words of a text stream until its present input is used up.

    State grows with the vocabulary only. Every batch writes just the words it changed,
    under its own batch number, so a repeated batch overwrites itself. ``tasks``
    redistributes batches of few files.
    """
    counts = word_counts(texts.repartition(tasks) if tasks else texts, items)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def current_counts(spark: SparkSession, output: str) -> DataFrame:
    """Latest count of every word: counts only grow, so the largest is the latest."""
    written = spark.read.schema("word string, n bigint, batch bigint").parquet(output)
    return written.groupBy("word").agg(F.max("n").alias("n"))


def top_words(spark: SparkSession, output: str, k: int) -> DataFrame:
    return most_common(current_counts(spark, output), k)
