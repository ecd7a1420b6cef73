"""Monte-Carlo estimate of pi from points that executors generate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _inside(x: Column, y: Column) -> Column:
    return F.when(x * x + y * y < 1, 1).otherwise(0)


def pi_random(spark: SparkSession, points: int, slices: int, seed: int) -> DataFrame:
    """Seeded random points in ``slices`` partitions; nothing is built on the driver."""
    drawn = spark.range(0, points, 1, slices).select((F.rand(seed) * 2 - 1).alias("x"), (F.rand(seed + 1) * 2 - 1).alias("y"))
    return drawn.agg((F.avg(_inside(F.col("x"), F.col("y"))) * 4).alias("pi"), F.count(F.lit(1)).alias("points"))


def pi_from_keys(df: DataFrame, key: str, points_per_row: int) -> DataFrame:
    """Repeatable points: ``points_per_row`` per integer key, by linear congruences."""
    steps = df.select(F.col(key).cast("bigint").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(points_per_row - 1))).alias("step"))
    ids = steps.select((F.col("key") * points_per_row + F.col("step")).alias("id"))
    # Multipliers, increments and moduli of the two generators.
    low = F.pmod(F.col("id"), F.lit(1 << 31))
    x = F.pmod(low * 1103515245 + 12345, F.lit(1 << 31)) / float(1 << 31) * 2 - 1
    y = F.pmod(low * 22695477 + 1, F.lit(1 << 32)) / float(1 << 32) * 2 - 1
    return ids.agg(F.sum(_inside(x, y)).alias("inside"), F.count(F.lit(1)).alias("points")).select(
        "points", "inside", (F.col("inside") * 4 / F.col("points")).alias("pi")
    )
