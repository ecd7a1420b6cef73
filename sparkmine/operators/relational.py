"""Grouped statistics, joins of facts to items, histograms and ordered concatenation.

Facts are summed per join key before any join, so a hot item costs one row per map
task instead of a skewed shuffle, and exploding items never multiplies the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.joins import join_lookup, stored_lookup
from sparkmine.operators.ordering import with_row_index, with_running_sums
from sparkmine.session import durable

# Fixed value: "Name (1999)" with optional trailing blanks.
TITLE_PATTERN = r"^(.*?)\s*\((\d{4})\)\s*$"


def with_title_parts(df: DataFrame, title: str = "title") -> DataFrame:
    """Split ``Name (YYYY)`` into title and year; titles without a year stay whole."""
    year = F.regexp_extract(title, TITLE_PATTERN, 2)
    name = F.when(year == "", F.col(title)).otherwise(F.regexp_extract(title, TITLE_PATTERN, 1))
    return df.withColumns({"year": year, title: name})


def stats(value: str) -> list[Column]:
    return [
        F.min(value).alias("min_rating"),
        F.avg(value).alias("avg_rating"),
        F.max(value).alias("max_rating"),
        F.count(value).alias("rating_cnt"),
    ]


def group_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """min, avg, max and count of ``value`` per group."""
    return df.groupBy(*keys).agg(*stats(value))


def summed_per_key(facts: DataFrame, key: str, value: str) -> DataFrame:
    """One row of mergeable partial statistics per key."""
    return facts.groupBy(key).agg(
        F.min(value).alias("p_min"), F.sum(value).alias("p_sum"), F.max(value).alias("p_max"), F.count(value).alias("p_cnt")
    )


def merged_stats(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge partial statistics of :func:`summed_per_key` into per-group statistics."""
    return joined.groupBy(*keys).agg(
        F.min("p_min").alias("min_rating"),
        F.try_divide(F.sum("p_sum"), F.sum("p_cnt")).alias("avg_rating"),
        F.max("p_max").alias("max_rating"),
        F.sum("p_cnt").alias("rating_cnt"),
    )


def joined_stats(items: DataFrame, facts: DataFrame, key: str, value: str, group_by: Sequence[str]) -> DataFrame:
    """Statistics of ``facts.value`` per item attribute, over ``items JOIN facts USING (key)``."""
    return merged_stats(items.join(summed_per_key(facts, key, value), key), group_by)


def above_global_average(grouped: DataFrame, facts: DataFrame, value: str) -> DataFrame:
    """Groups whose average exceeds the average of all facts (scalar subquery)."""
    return grouped.where(F.col("avg_rating") > facts.agg(F.avg(value)).scalar())


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def row_with_max(df: DataFrame, value: str, *columns: str) -> DataFrame:
    """The columns of the row that holds the largest ``value`` (largest columns on ties)."""
    best = F.max(F.struct(F.col(value), *[F.col(c) for c in columns]))
    return df.agg(best.alias("best")).select("best.*")


def multi_hot(df: DataFrame, array_column: str, values: Sequence[str], prefix: str = "", others: str | None = None) -> DataFrame:
    """One boolean column per value of a list that the caller gives, all in a single projection.

    ``others`` names an array column for the elements outside the list (distinct, sorted), so that no element is lost
    however many there are.
    """
    flags = [F.array_contains(array_column, v).alias(f"{prefix}{v}") for v in values]
    if others is not None:
        listed = F.array(*map(F.lit, values)).cast(df.schema[array_column].dataType)
        flags.append(F.array_sort(F.array_except(array_column, listed)).alias(others))
    return df.select(*[c for c in df.columns if c != array_column], *flags)


def element_values(df: DataFrame, array_column: str) -> DataFrame:
    """Distinct array elements, one row ``(v)`` each; NULL elements are left out."""
    return df.select(F.explode(array_column).alias("v")).where("v IS NOT NULL").distinct()


def _edges(low: Column, high: Column, bins: int) -> tuple[Column, Column]:
    """Lower edge and bin width; a constant column gets a range of one around it."""
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    return start, F.when(flat, F.lit(1.0 / bins)).otherwise((high - low) / bins)


def histogram(df: DataFrame, columns: Sequence[str], bins: int, weight: Column | None = None) -> DataFrame:
    """Equal-width histogram of one or many columns in two passes, empty bins included.

    Output ``(name, bin, bin_lo, bin_hi, n)``; the last bin is closed on the right. With
    ``weight`` the bins sum weights instead of counting rows.
    """
    source = df.select(*[F.col(c).cast("double").alias(c) for c in columns], (F.lit(1) if weight is None else weight).alias("__w"))
    present = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]
    limits = durable(source.agg(F.struct(*present).alias("limits")))  # one row

    def bucket(c: str) -> Column:
        start, width = _edges(F.col(f"__limits.{c}.lo"), F.col(f"__limits.{c}.hi"), bins)
        return F.least(F.floor((F.col(c) - start) / width), F.lit(bins - 1)).cast("int")

    pairs = F.array(*[F.struct(F.lit(c).alias("name"), bucket(c).alias("bin")) for c in columns])
    placed = source.withColumn("__limits", limits.scalar()).select(F.inline(pairs), "__w")
    filled = placed.where(F.col("bin").isNotNull()).groupBy("name", "bin").agg(F.sum("__w").alias("n"))

    def frame(c: str) -> Column:
        start, width = _edges(F.col(f"limits.{c}.lo"), F.col(f"limits.{c}.hi"), bins)
        return F.transform(
            F.sequence(F.lit(0), F.lit(bins - 1)),
            lambda b: F.struct(
                F.lit(c).alias("name"), b.alias("bin"), (start + width * b).alias("bin_lo"), (start + width * (b + 1)).alias("bin_hi")
            ),
        )

    empty = limits.select(F.inline(F.flatten(F.array(*[frame(c) for c in columns]))))
    return empty.join(filled, ["name", "bin"], "left").select("name", "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).alias("n"))


def correlations(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Pearson correlation of every feature with the label in one pass; NULL if constant."""

    def corr(feature: str) -> Column:
        x = F.when(F.col(label).isNotNull(), F.col(feature).cast("double"))
        y = F.when(F.col(feature).isNotNull(), F.col(label).cast("double"))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    rows = F.array(*[F.struct(F.lit(f).alias("feature"), corr(f).alias("corr")) for f in features])
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def _joined(pieces: Column, sep: str) -> Column:
    """Pieces (structs ``at``, ``piece``) in order, joined to one text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(pieces)), lambda p: p["piece"]), sep)


def _one_text(parts: DataFrame, key: str, text: str, sep: str, *sums: str) -> DataFrame:
    """The parts of a key in order, as one row."""
    whole = _joined(F.struct(F.col("part").alias("at"), F.col(text).alias("piece")), sep)
    return parts.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums], whole.alias(text))


def ordered_concat(df: DataFrame, key: str, order_by: Sequence[str], text: str, sep: str = "\n", part_rows: int = 1000) -> DataFrame:
    """Texts of a key joined in order, as one row ``(key, n, text)``; a NULL text is empty.

    Keys with more than ``part_rows`` pieces are sorted and joined in two levels: parts of that many pieces in parallel
    tasks, then the parts in order. ``part_rows`` never shows in the result.
    """
    rows = df.select(key, *order_by, F.coalesce(text, F.lit("")).alias(text))
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > part_rows)
    large = stored_lookup(sizes.select(key, F.lit(True).alias("__large")))

    def collected(part: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
        piece = F.struct(order.alias("at"), F.col(text).alias("piece"))
        return part.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), _joined(piece, sep).alias(text))

    if not large.size:
        return collected(rows, [key], F.struct(*order_by))
    marked = join_lookup(rows, large, [key], "left")
    small = collected(marked.where("__large IS NULL"), [key], F.struct(*order_by))
    placed = with_row_index(marked.where("__large").drop("__large"), order_by, within=[key], name="__at")
    parts = collected(placed.withColumn("part", F.floor(F.col("__at") / part_rows)), [key, "part"], F.col("__at"))
    return small.unionByName(_one_text(parts, key, text, sep, "n").select(small.columns))


def sorted_label_concat(counted: DataFrame, key: str, label: str, n: str, sep: str = " ", part_rows: int = 1000) -> DataFrame:
    """Repeated labels of a key in label order, as one row ``(key, labels)``.

    Input is one row per (key, label) with its count. A key with more than ``part_rows`` labels is joined in two levels:
    parts of that many labels, by running counts, then the parts in order.
    """
    rows = counted.select(key, label, F.col(n).alias("__n"))
    sizes = rows.groupBy(key).agg(F.sum("__n").alias("__all")).where(F.col("__all") > part_rows)
    large = stored_lookup(sizes.select(key, F.lit(True).alias("__large")))

    def collected(part: DataFrame, by: Sequence[str], copies: Column) -> DataFrame:
        repeated = F.array_join(F.array_repeat(F.col(label), copies.cast("int")), sep)
        return part.groupBy(*by).agg(_joined(F.struct(F.col(label).alias("at"), repeated.alias("piece")), sep).alias("labels"))

    if not large.size:
        return collected(rows, [key], F.col("__n"))
    marked = join_lookup(rows, large, [key], "left")
    small = collected(marked.where("__large IS NULL"), [key], F.col("__n"))
    ranked = with_running_sums(marked.where("__large").drop("__large"), [label], {"__end": F.col("__n")}, within=[key])
    first = F.col("__end") - F.col("__n")
    covered = F.sequence(F.floor(first / part_rows), F.floor((F.col("__end") - 1) / part_rows))
    spans = ranked.select(key, label, first.alias("__first"), "__end", F.explode(covered).alias("part"))
    copies = F.least(F.col("__end"), (F.col("part") + 1) * part_rows) - F.greatest(F.col("__first"), F.col("part") * part_rows)
    return small.unionByName(_one_text(collected(spans, [key, "part"], copies), key, "labels", sep))
