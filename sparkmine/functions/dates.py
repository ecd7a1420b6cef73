"""Calendar and epoch columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def with_epoch_datetime(df: DataFrame, epoch: str, out: str = "datetime") -> DataFrame:
    """Epoch seconds to a date-time string in the session time zone."""
    return df.withColumn(out, F.from_unixtime(F.col(epoch)))


def with_current_parts(df: DataFrame) -> DataFrame:
    """Year, month, day and hour of the query's start."""
    now = F.now()
    return df.withColumns({"year": F.year(now), "month": F.month(now), "day": F.day(now), "hour": F.hour(now)})


def release_gap(ts: Column, year_text: Column) -> Column:
    """Years between a date and a release year given as text; NULL for non-years."""
    return F.year(ts) - year_text.try_cast("int")


def fractional_year(year: str = "year", month: str = "month") -> Column:
    return F.expr(f"{year} + (cast({month} as double) - 1) / 12")


def periodic_columns(t: Column, periods: list[float]) -> dict[str, Column]:
    """sin and cos of ``2*pi*t/period`` for every period, named ``sin_7``, ``cos_365_25``."""
    out = {}
    for period in periods:
        suffix = str(period).replace(".", "_")
        angle = F.lit(2 * math.pi) * t / F.lit(float(period))
        out[f"sin_{suffix}"] = F.sin(angle)
        out[f"cos_{suffix}"] = F.cos(angle)
    return out
