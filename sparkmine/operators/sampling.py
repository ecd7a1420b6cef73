"""Train/test splits, folds, shuffles and samples that do not depend on partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.operators.joins import join_lookup
from sparkmine.operators.ordering import keys_at, order_key, seeded_key, with_row_index
from sparkmine.session import durable


def hash_split(df: DataFrame, key: str, weights: dict[str, float], seed: int, name: str = "split") -> DataFrame:
    """Label every row with a part by a seeded hash of its integer key (no shuffle)."""
    point = seeded_key(key, seed)
    total, reached = sum(weights.values()), 0.0
    chosen: Column | None = None
    parts = list(weights.items())
    for part, weight in parts[:-1]:
        reached += weight / total
        inside = point < int(reached * 2147483647)
        chosen = F.when(inside, part) if chosen is None else chosen.when(inside, part)
    last = parts[-1][0]
    return df.withColumn(name, F.lit(last) if chosen is None else chosen.otherwise(last))


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Seeded Bernoulli split of the engine; depends on the input's partitioning."""
    return df.randomSplit(list(weights), seed)


def _borders(df: DataFrame, order_by: Sequence[str], positions: Sequence[int], n: int) -> DataFrame:
    """Stored ``(position, key)`` rows at the positions; a key that also stands before its border is an error.

    Rows with equal order keys would all fall on one side of a border, so that the parts had other sizes than asked for.
    """
    if not all(isinstance(c, str) for c in order_by):
        raise TypeError("order_by takes column names, in ascending order; add a column for any other order")
    found = durable(keys_at(df, order_by, [*positions, *(p - 1 for p in positions)], n))  # two rows a border
    asked = F.col("position").isin(list(positions))
    before = found.select((F.col("position") + 1).alias("position"), F.col("key").alias("earlier"))
    if found.join(before, "position").where(asked & F.col("key").eqNullSafe(F.col("earlier"))).limit(1).count():
        raise ValueError(f"rows with equal {list(order_by)} lie on both sides of a border: add a tie-break column")
    return found.where(asked)


def fixed_split(df: DataFrame, order_by: Sequence[str], fraction: float, name: str = "split") -> DataFrame:
    """First ``floor(fraction * n)`` rows in ascending order are train, the rest test. Ties at the border are an error."""
    n = df.count()
    first_test = _borders(df, order_by, [math.floor(n * fraction)], n).select("key").scalar()
    return df.withColumn(name, F.when(order_key(order_by) >= first_test, "test").otherwise("train"))


def shuffled_split(df: DataFrame, key: str, fraction: float, seed: int, name: str = "split") -> DataFrame:
    """Fixed split of the rows in seeded shuffle order."""
    return fixed_split(df.withColumn("__seeded", seeded_key(key, seed)), ["__seeded", key], fraction, name).drop("__seeded")


def _last_border(borders: Column, key: Column) -> Column:
    """The fold of the last border at or before a key."""
    return F.element_at(F.filter(borders, lambda b: b["key"] <= key), -1)["fold"]


def kfold(df: DataFrame, order_by: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """Contiguous folds in ascending order; the first ``n mod k`` folds hold one row more. Ties at a border are an error."""
    n = df.count()
    small, extra = divmod(n, k)
    start = [f * small + min(f, extra) for f in range(k)]
    found = _borders(df, order_by, start, n)
    # Empty folds (fewer rows than folds) share a start; the lowest fold owns it.
    fold = F.array_position(F.array(*[F.lit(s).cast("bigint") for s in start]), F.col("position")) - 1
    borders = durable(found.select("key", fold.cast("int").alias("fold")))  # at most k rows
    listed = borders.agg(F.array_sort(F.collect_list(F.struct("key", "fold")))).scalar()
    # Borders rise with their folds, so the largest fold begun at or before the row's key owns it.
    begun = [F.when(order_key(order_by) >= F.get("__borders", F.lit(i))["key"], F.get("__borders", F.lit(i))["fold"]) for i in range(k)]
    fold = F.greatest(*begun) if k > 1 else F.lit(0)
    return df.withColumn("__borders", listed).select(*df.columns, fold.cast("int").alias(name))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int, name: str = "fold") -> DataFrame:
    """Contiguous folds in ``key`` order inside every class, with class shares equal to
    within one row.

    Classes are lined up by first appearance; a fold takes from a class as many rows as it
    would by dealing that line out one row at a time. Only keys and labels are sorted: a
    class's folds are key ranges, so wide rows find their fold from k borders. Rows
    without a label get no fold.
    """
    ranked = with_row_index(df.select(label, key), [key], within=[label], name="__rank")
    classes = durable(ranked.groupBy(label).agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__first")))
    # One row per class; the running start of a class in the line needs their order.
    line = Window.orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("__start", F.coalesce(F.sum("__n").over(line), F.lit(0)))

    def dealt(fold: Column) -> Column:
        """Rows that the class gives to folds before ``fold``."""
        left, begin = F.pmod("__n", F.lit(k)), F.pmod("__start", F.lit(k))
        more = F.size(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i < fold) & (F.pmod(i - begin, F.lit(k)) < left)))
        return F.floor(F.col("__n") / k) * fold + more

    folds = F.sequence(F.lit(0), F.lit(k - 1))
    starts = classes.select(label, F.explode(F.transform(folds, lambda f: F.struct(dealt(f).alias("__rank"), f.alias("fold")))).alias("s"))
    # An empty fold starts where the next one does; the latest fold owns the rows.
    starts = starts.groupBy(label, F.col("s.__rank").alias("__rank")).agg(F.max("s.fold").alias("fold"))
    borders = join_lookup(ranked, starts, [label, "__rank"])
    per_class = borders.groupBy(label).agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), "fold"))).alias("__borders"))
    return join_lookup(df, per_class, [label], "left").select(*df.columns, _last_border(F.col("__borders"), F.col(key)).alias(name))


def shuffle_positions(df: DataFrame, key: str, seed: int, name: str = "position") -> DataFrame:
    """Position of every row in seeded shuffle order."""
    return with_row_index(df, [seeded_key(key, seed), F.col(key)], name=name)


def sample(df: DataFrame, fraction: float, seed: int | None = None, key: str | None = None) -> DataFrame:
    """Bernoulli sample without replacement; with an integer ``key`` the same rows on any partitioning."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(seeded_key(key, seed or 0) < int(fraction * 2147483647))
