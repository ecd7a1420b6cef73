"""CSV, gzip CSV, text and Parquet readers and writers, and driver-side edges."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    multi_line: bool = False,
    partitions: int | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Read CSV (plain or gzip, one path or many).

    Without ``schema`` the types are inferred, which costs one extra read of the data.
    ``partitions`` redistributes a gzip scan, which is one task per file otherwise;
    ``file_column`` keeps the file name as a group key for per-file jobs.
    ``multi_line`` reads quoted line breaks with doubled quotes.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("quote", quote)
    if multi_line:
        reader = reader.option("multiLine", True).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if file_column:
        df = df.select("*", F.col("_metadata.file_name").alias(file_column))
    return df.repartition(partitions) if partitions else df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files as ``(url, html)`` rows."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def write_csv(df: DataFrame, path: str, sep: str = ",", files: int | None = None) -> None:
    """Overwrite ``path`` with CSV; ``files`` fixes the number of part files (exports)."""
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def from_strings(spark: SparkSession, values: Sequence[str]) -> DataFrame:
    """Local strings as a one-column table named ``value``."""
    return spark.createDataFrame([(v,) for v in values], "value string")


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def iter_rows(df: DataFrame) -> Iterator[Row]:
    """Rows one partition at a time, never the whole table on the driver."""
    return df.toLocalIterator(prefetchPartitions=True)


def iter_batches(df: DataFrame, batch_size: int) -> Iterator[list[Row]]:
    batch: list[Row] = []
    for row in iter_rows(df):
        batch.append(row)
        if len(batch) == batch_size:
            yield batch
            batch = []
    if batch:
        yield batch


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str, batch_size: int | None = None
) -> DataFrame:
    """Apply a pandas function to batches of rows on the executors, for work that column
    expressions cannot express. Batches never cross partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch_size or max(len(batch), 1)
            for start in range(0, len(batch), size):
                yield fn(batch.iloc[start : start + size])

    return df.mapInPandas(run, schema)


def column_values(df: DataFrame, column: str) -> Iterator:
    """One column's values streamed to the caller."""
    return (row[0] for row in iter_rows(df.select(column)))
