"""Lags, autocorrelation, decomposition and spectrum of an integer-indexed series.

Neighbouring rows meet inside blocks of consecutive time steps. A block also receives the
few rows just outside it, so windows never cross blocks and no task sees the whole series.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sparkmine.session import durable

BLOCK = 16384


def daily_counts(df: DataFrame, ts: str) -> DataFrame:
    """Gap-free ``(t, day, y)``: rows per calendar day, 0 where none, t counted from the first day."""
    counted = durable(df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n")).where("day IS NOT NULL"))
    limits = counted.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = limits.select("first", F.explode(F.sequence("first", "last")).alias("day"))
    filled = calendar.join(counted, "day", "left")
    return filled.select(F.datediff("day", "first").alias("t"), "day", F.coalesce("n", F.lit(0)).cast("double").alias("y"))


def with_halo(series: DataFrame, t: str, before: int, after: int, block: int = BLOCK) -> tuple[DataFrame, WindowSpec, Column]:
    """Rows copied to every block that needs them, the window over a block, and the test
    for rows that belong to the block. A row at t serves the rows in [t - after, t + before]."""
    first, last = F.floor((F.col(t) - after) / block), F.floor((F.col(t) + before) / block)
    spread = series.withColumn("__block", F.explode(F.sequence(first, last)))
    own = F.col("__block") == F.floor(F.col(t) / block)
    return spread, Window.partitionBy("__block").orderBy(t), own


def lag_pairs(series: DataFrame, max_lag: int, t: str = "t", y: str = "y", block: int = BLOCK) -> DataFrame:
    """``(t, k, y, y_next)``: every value with the values 0..max_lag steps later."""
    spread, window, own = with_halo(series.select(t, y), t, 0, max_lag, block)
    ahead = F.collect_list(F.struct(F.col(t).alias("at"), F.col(y).alias("value"))).over(window.rangeBetween(0, max_lag))
    rows = spread.withColumn("__ahead", ahead).where(own)
    # Rows before a block's first own row only serve the previous block.
    return rows.select(F.col(t), F.col(y), F.inline("__ahead")).select(t, (F.col("at") - F.col(t)).alias("k"), y, F.col("value").alias("y_next"))


def autocorrelation(series: DataFrame, max_lag: int, t: str = "t", y: str = "y", block: int = BLOCK) -> DataFrame:
    """ACF to ``max_lag`` with Bartlett's 95 % band around zero for the lag."""
    stored = durable(series.select(t, y))
    base = stored.agg(F.struct(F.avg(y).alias("mean"), F.count(y).alias("n"), F.var_pop(y).alias("var"))).scalar()
    centred = stored.select(F.col(t), (F.col(y) - base["mean"]).alias(y))
    sums = lag_pairs(centred, max_lag, t, y, block).groupBy("k").agg(F.sum(F.col(y) * F.col("y_next")).alias("s"))
    acf = durable(sums.select(F.col("k").cast("int").alias("lag"), F.try_divide(F.col("s"), base["var"] * base["n"]).alias("acf")))
    # max_lag + 1 rows from here on.
    earlier = Window.orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(0.0)).over(earlier)
    band = F.lit(1.959963984540054) * F.sqrt((1 + 2 * F.coalesce(inner, F.lit(0.0))) / base["n"])
    return acf.withColumn("band", F.when(F.col("lag") > 0, band).otherwise(F.lit(0.0)))


def lag_correlations(series: DataFrame, lags: int, t: str = "t", y: str = "y", block: int = BLOCK) -> DataFrame:
    """Pearson correlation of every pair of shifted copies 0..lags-1, complete pairs only.

    Copies i and j (d = |i - j|, m = max) pair y(s) with y(s + d) for s up to n - 1 - m.
    One pass sums the pairs per d and per distance from the end; the matrix then needs
    only running sums over those few rows.
    """
    stored = durable(series.select(t, y))
    base = stored.agg(F.struct(F.avg(y).alias("mean"), F.max(t).alias("last"))).scalar()
    centred = stored.select(F.col(t), (F.col(y) - base["mean"]).alias(y))
    pairs = lag_pairs(centred, lags - 1, t, y, block)
    room = F.least(base["last"] - F.col(t), F.lit(lags - 1)).cast("int")
    a, b = F.col(y), F.col("y_next")
    parts = pairs.groupBy(F.col("k").cast("int").alias("d"), room.alias("room")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(a).alias("sa"), F.sum(b).alias("sb"),
        F.sum(a * a).alias("saa"), F.sum(b * b).alias("sbb"), F.sum(a * b).alias("sab"),
    )
    enough = Window.partitionBy("d").orderBy(F.desc("room")).rowsBetween(Window.unboundedPreceding, 0)
    names = ("n", "sa", "sb", "saa", "sbb", "sab")
    # At most lags * lags rows: per d the sums over all pairs that fit the larger shift m.
    cumulative = durable(parts).select("d", F.col("room").alias("m"), *[F.sum(c).over(enough).alias(c) for c in names])
    n = F.col("n")
    va, vb = F.col("saa") - F.col("sa") * F.col("sa") / n, F.col("sbb") - F.col("sb") * F.col("sb") / n
    cov = F.col("sab") - F.col("sa") * F.col("sb") / n
    corr = F.when(F.col("d") == 0, F.lit(1.0)).otherwise(F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb)))
    cells = cumulative.select(F.col("m"), (F.col("m") - F.col("d")).alias("o"), F.when(va > 0, corr).alias("corr"))
    both = F.array(F.struct(F.col("m").alias("i"), F.col("o").alias("j")), F.struct(F.col("o").alias("i"), F.col("m").alias("j")))
    return cells.select(F.inline(F.array_distinct(both)), "corr")


def seasonal_decompose(series: DataFrame, period: int, t: str = "t", y: str = "y", block: int = BLOCK) -> DataFrame:
    """Additive trend, seasonal and residual parts of a gap-free series.

    Trend is the centred moving average (half weights at both ends for an even period);
    the ends follow the least-squares line of the nearest ``period`` trend points.
    """
    stored = durable(series.select(t, y))
    half = period // 2
    spread, window, own = with_halo(stored, t, half, half, block)
    frame = window.rangeBetween(-half, half)
    total = F.sum(y).over(frame)
    if period % 2 == 0:
        total = total - (F.first(y).over(frame) + F.last(y).over(frame)) / 2
    average = F.when(F.count(y).over(frame) == 2 * half + 1, total / period)
    inner = durable(spread.withColumn("trend", average).where(own).select(t, y, "trend"))

    last = inner.agg(F.max(t)).scalar()
    known = inner.where("trend IS NOT NULL")
    line = F.struct(F.regr_slope("trend", t).alias("slope"), F.regr_intercept("trend", t).alias("intercept"))
    head = known.where(F.col(t) < half + period).agg(line).scalar()
    tail = known.where(F.col(t) > last - half - period).agg(line).scalar()
    outside = F.when(F.col(t) < half, head["intercept"] + head["slope"] * F.col(t)).otherwise(
        tail["intercept"] + tail["slope"] * F.col(t)
    )
    detrended = inner.withColumn("trend", F.coalesce("trend", outside)).withColumn("__d", F.col(y) - F.col("trend"))
    phase = F.pmod(F.col(t), F.lit(period)).cast("int")
    # One row per phase: the period bounds both the map and its mean.
    phases = durable(detrended.groupBy(phase.alias("phase")).agg(F.avg("__d").alias("mean")))
    level = phases.agg(F.avg("mean")).scalar()
    effects = phases.agg(F.map_from_entries(F.collect_list(F.struct("phase", "mean")))).scalar()
    parts = detrended.withColumn("seasonal", F.try_element_at(effects, phase) - level)
    return parts.select(t, y, "trend", "seasonal", (F.col("__d") - F.col("seasonal")).alias("resid"))


def amplitude_spectrum(series: DataFrame, bins: int, t: str = "t", y: str = "y") -> DataFrame:
    """``(k, amplitude)`` of frequency bins 1..bins: all bins in one aggregate."""
    stored = durable(series.select(t, y))
    size = stored.agg(F.count(y)).scalar()
    turned = stored.withColumn("__angle", F.lit(2 * math.pi) * F.col(t) / size)
    parts = [
        F.struct(
            F.lit(k).alias("k"),
            F.sum(F.col(y) * F.cos(F.col("__angle") * k)).alias("re"),
            F.sum(F.col(y) * F.sin(F.col("__angle") * k)).alias("im"),
            F.count(y).alias("n"),
        )
        for k in range(1, bins + 1)
    ]
    summed = turned.agg(F.array(*parts).alias("bins")).select(F.inline("bins"))
    return summed.select("k", (F.lit(2.0) / F.col("n") * F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))).alias("amplitude"))
