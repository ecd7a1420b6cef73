"""Positions and running sums over a total order, without a single-task window.

Rows are range-partitioned by the ordering key, so each task sorts one slice. Only the
per-slice totals (one row per slice) go through an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.session import durable

_PART = "__part"


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def with_row_index(df: DataFrame, order_by: Sequence[str | Column], within: Sequence[str] = (), name: str = "row_index") -> DataFrame:
    """Add the 0-based position in ``order_by`` order, over the table or inside each
    ``within`` group. ``order_by`` must be unique (add a tie-break key).

    A group that holds most of the rows is still spread over many slices: a slice is
    numbered alone, then shifted by what the group has in earlier slices.
    """
    if within:
        return with_running_sums(df, order_by, {name: F.lit(1).cast("bigint")}, within, inclusive=False)
    order = [_column(c) for c in order_by]
    # Sorted slices number themselves: the id holds the slice above bit 33, the place below.
    sliced = durable(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sliced.groupBy(part.alias("__shift_part")).agg(F.max(place).alias("__last"))
    earlier = Window.orderBy("__shift_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: safe to broadcast.
    shifts = sizes.select("__shift_part", F.coalesce(F.sum(F.col("__last") + 1).over(earlier), F.lit(0)).alias("__shift"))
    shifted = sliced.join(F.broadcast(shifts), part == F.col("__shift_part"))
    return shifted.select(*[F.col(f"`{c}`") for c in df.columns], (place + F.col("__shift")).alias(name))


def with_running_sums(
    df: DataFrame,
    order_by: Sequence[str | Column],
    sums: dict[str, Column],
    within: Sequence[str] = (),
    inclusive: bool = True,
    totals: Sequence[str] = (),
) -> DataFrame:
    """Add one running sum per entry of ``sums`` in ``order_by`` order (``inclusive``
    counts the row itself). ``order_by`` must be unique inside a ``within`` group.

    ``totals`` names columns for the sums over the group (one per entry of ``sums``); they
    need a single slice table, so they are only given without ``within``.
    """
    if totals and within:
        raise ValueError("totals are only given over the whole table")
    order = [_column(c) for c in order_by]
    groups = list(within)
    addends = {f"__add_{i}": F.coalesce(expr, F.lit(0)) for i, expr in enumerate(sums.values())}
    sliced = durable(
        df.withColumns(addends)
        .repartitionByRange(*[F.col(g) for g in groups], *order)
        .withColumn(_PART, F.spark_partition_id())
    )

    # A group crosses a slice border at most (slices - 1) times in total, so the shifts
    # kept below have fewer rows than there are shuffle slices: safe to broadcast.
    per_slice = sliced.groupBy(*groups, _PART).agg(*[F.sum(a).alias(a) for a in addends])
    earlier = Window.partitionBy(*groups).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_slice.select(
        *[F.col(g).alias(f"__group_{i}") for i, g in enumerate(groups)],
        F.col(_PART).alias("__shift_part"),
        *[F.sum(a).over(earlier).alias(f"__shift{a}") for a in addends],
        *[F.sum(a).over(Window.partitionBy()).alias(out) for a, out in zip(addends, totals)],
    )
    if not totals:
        shifts = shifts.where(" OR ".join(f"`__shift{a}` IS NOT NULL" for a in addends))

    local = Window.partitionBy(*groups, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = sliced.withColumns({f"__run{a}": F.sum(a).over(local) for a in addends})
    match = F.col(_PART) == F.col("__shift_part")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"__group_{i}"))
    shifted = numbered.join(F.broadcast(shifts), match, "left")

    def total(a: str) -> Column:
        value = F.col(f"__run{a}") + F.coalesce(F.col(f"__shift{a}"), F.lit(0))
        return value if inclusive else value - F.col(a)

    running = [total(a).alias(out) for a, out in zip(addends, sums)]
    return shifted.select(*[F.col(f"`{c}`") for c in df.columns], *running, *totals)


def top_k(df: DataFrame, k: int, *order_by: Column) -> DataFrame:
    """First ``k`` rows of a total order (planned as a per-task top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(k)


SLICES = 64
SAMPLED = 5_000  # keys that the slice borders are chosen from; borders steer the work, never the result


def keys_at(df: DataFrame, order_by: Sequence[str | Column], positions: Sequence[int], n: int | None = None) -> DataFrame:
    """``(position, key)``: the order keys, as a struct, found at some positions; positions outside the table are left out.

    Multi-rank selection without sorting the table: rows are counted per key range, and only the ranges that hold a
    wanted position are sorted. Wide rows are then compared with these few keys where they are, instead of being moved.
    """
    keys = df.select(order_key(order_by).alias("key"))
    n = keys.count() if n is None else n
    wanted = sorted({p for p in positions if 0 <= p < n})
    kind = keys.schema["key"].dataType
    if not wanted:
        return df.sparkSession.createDataFrame([], "position bigint, key " + kind.simpleString())
    sample = [r["key"] for r in keys.sample(fraction=min(1.0, SAMPLED / n), seed=1).distinct().orderBy("key").collect()]  # about SAMPLED keys
    cuts = [sample[i] for i in sorted({i * len(sample) // SLICES for i in range(1, SLICES)} - {0})] if sample else []
    borders = df.sparkSession.createDataFrame([(cuts,)], T.StructType([T.StructField("cuts", T.ArrayType(kind))]))
    placed = keys.withColumn("cuts", borders.scalar()).withColumn("slice", _slice_of(F.col("cuts"))).drop("cuts")
    sizes = {r["slice"]: r["count"] for r in placed.groupBy("slice").count().collect()}
    starts, total = {}, 0
    for i in range(SLICES):
        starts[i], total = total, total + sizes.get(i, 0)
    holding = {max(i for i in starts if starts[i] <= p and sizes.get(i)): None for p in wanted}
    rows = [(i, starts[i]) for i in holding]
    offsets = F.broadcast(df.sparkSession.createDataFrame(rows, "slice int, start bigint"))  # one row per wanted slice at most
    inside = placed.where(F.col("slice").isin(list(holding)))
    numbered = with_row_index(inside, ["slice", "key"], name="__place")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = df.sparkSession.createDataFrame([(i, sizes[i]) for i in sorted(holding)], "slice int, size bigint")
    earlier = earlier.select("slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("earlier"))
    found = numbered.join(offsets, "slice").join(F.broadcast(earlier), "slice")
    found = found.select((F.col("__place") - F.col("earlier") + F.col("start")).alias("position"), "key")
    return found.where(F.col("position").isin(wanted))


def _slice_of(cuts: Column) -> Column:
    """How many of the rising cuts are at most the row's key: a binary search inside the row."""
    widths = F.array(*[F.lit(1 << i) for i in reversed(range(SLICES.bit_length()))])
    step = lambda low, width: F.when(F.col("key") >= F.get(cuts, low + width - 1), low + width).otherwise(low)  # noqa: E731 - no cut there: stay
    return F.aggregate(widths, F.lit(0), step)


def order_key(order_by: Sequence[str | Column]) -> Column:
    """The struct that :func:`keys_at` borders compare with."""
    return F.struct(*[_column(c).alias(f"k{i}") for i, c in enumerate(order_by)])


def series_slice(df: DataFrame, order_by: Sequence[str | Column], start: int, end: int = -1) -> DataFrame:
    """Rows at positions ``[start, end)`` of the ordered table with their ``position``;
    ``end=-1`` means to the end."""
    start = max(start, 0)
    borders = {r["position"]: r["key"] for r in durable(keys_at(df, order_by, [start, end])).collect()}  # two rows
    key, kind = order_key(order_by), df.select(order_key(order_by).alias("key")).schema["key"].dataType

    def border(position: int) -> Column:
        row = df.sparkSession.createDataFrame([(borders[position],)], T.StructType([T.StructField("key", kind)]))
        return row.scalar()

    kept = df.where(key >= border(start)) if start in borders else df.limit(0)
    if end in borders:
        kept = kept.where(key < border(end))
    elif end == 0:
        kept = df.limit(0)
    return with_row_index(kept, order_by, name="position").withColumn("position", F.col("position") + start)


def seeded_key(key: str | Column, seed: int) -> Column:
    """Integer in [0, 2^31 - 2] mixed from an integer key and a seed by two Lehmer steps.

    Plain arithmetic that stays inside a bigint, so that any SQL engine repeats it.
    """
    modulus = 2147483647
    base = _column(key).cast("bigint")
    first = F.pmod(F.pmod(base, F.lit(modulus)) * 48271 + (seed * 16807 + 11), F.lit(modulus))
    mixed = first * 69621 + F.floor(first / 65536)
    return F.pmod(mixed.cast("bigint"), F.lit(modulus))


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Seeded shuffle: order by a hash of the row key, stable under re-partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key))


def with_previous(df: DataFrame, order_by: Sequence[str], columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add the previous row's ``columns`` in the total order ``order_by`` (NULL on the first).

    Only the last row of every slice moves between slices.
    """
    keys = list(order_by)
    sliced = durable(df.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()))
    values = F.struct(*[F.col(c) for c in columns])
    last = sliced.groupBy(_PART).agg(F.max_by(values, F.struct(*keys)).alias("__last"))
    # One row per slice.
    carried = last.select(F.col(_PART), F.lag("__last").over(Window.orderBy(_PART)).alias("__carried"))
    before = F.lag(values).over(Window.partitionBy(_PART).orderBy(*keys))
    joined = sliced.withColumn("__before", before).join(F.broadcast(carried), _PART)
    return joined.select(*df.columns, *[F.coalesce(f"__before.{c}", f"__carried.{c}").alias(f"{prefix}{c}") for c in columns])
