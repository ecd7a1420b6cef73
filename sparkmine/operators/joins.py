"""Equi-joins of large facts to lookups, safe against hot keys and growing lookups."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.session import durable

BROADCAST_BYTES = 128 * 1024 * 1024
HOT_SHARE = 1 / 256
SALTS = 64


@dataclass(frozen=True)
class Lookup:
    """A stored lookup table with its measured size, reusable by many joins.

    ``weight`` may name a column that tells how often a key is expected in the facts. It
    only guides how a large lookup is split and never appears in a join's result.
    """

    rows: DataFrame
    size: int
    weight: str | None = None
    sizes: dict[int, int] | None = None  # of the rows of each weight step


def _text_size() -> Column:
    return F.octet_length(F.to_json(F.struct("*")))


def _weight_step(weight: str) -> Column:
    """Steps of a quarter of a doubling: 256 at most."""
    return F.floor(F.log2(F.greatest(F.col(weight), F.lit(1))) * 4).cast("int")


def measured_lookup(rows: DataFrame, weight: str | None = None) -> Lookup:
    """Measure stored rows as text, by one aggregate."""
    if weight is None:
        return Lookup(rows, rows.agg(F.sum(_text_size())).first()[0] or 0)
    sized = rows.select(_weight_step(weight).alias("step"), _text_size().alias("size"))
    sizes = {r["step"]: r["size"] for r in sized.groupBy("step").agg(F.sum("size").alias("size")).collect()}
    return Lookup(rows, sum(sizes.values()), weight, sizes)


def stored_lookup(df: DataFrame, weight: str | None = None) -> Lookup:
    return measured_lookup(durable(df), weight)


def join_lookup(
    facts: DataFrame, lookup: DataFrame | Lookup, on: Sequence[str], how: str = "inner", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join facts to a lookup that was aggregated from data.

    The lookup is stored once and measured, and broadcast only below ``broadcast_bytes``.
    Beyond that its heaviest keys are broadcast and the rest shuffled, if it has weights;
    otherwise all facts are shuffled with the hot keys salted.
    """
    table = lookup if isinstance(lookup, Lookup) else stored_lookup(lookup)
    rows = table.rows.drop(table.weight) if table.weight else table.rows
    if table.size <= broadcast_bytes:
        return facts.join(F.broadcast(rows), list(on), how)
    if table.weight:
        return _split_join(facts, table, list(on), how, broadcast_bytes)
    return salted_join(facts, rows, on, how)


def heavy_and_light(table: Lookup, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame | None, DataFrame]:
    """As many of a weighted lookup's heaviest keys as fit a broadcast, None if not even the first do, and the other keys."""
    step, room, cut = _weight_step(table.weight), broadcast_bytes, None
    for level in sorted(table.sizes, reverse=True):
        if table.sizes[level] > room:
            break
        room, cut = room - table.sizes[level], level
    if cut is None:
        return None, table.rows.drop(table.weight)
    return table.rows.where(step >= cut).drop(table.weight), table.rows.where(step < cut).drop(table.weight)


def _split_join(facts: DataFrame, table: Lookup, on: list[str], how: str, broadcast_bytes: int) -> DataFrame:
    """Broadcast as many of the heaviest keys as surely fit, shuffle only the other facts."""
    heavy, light = heavy_and_light(table, broadcast_bytes)
    if heavy is None:
        return salted_join(facts, light, on, how)
    heavy = F.broadcast(heavy)
    matched = facts.join(heavy, on, "inner")
    rest = salted_join(facts.join(F.broadcast(heavy.select(*on)), on, "left_anti"), light, on, how)
    return matched.unionByName(rest.select(matched.columns))


def salted_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", hot_share: float = HOT_SHARE, salts: int = SALTS
) -> DataFrame:
    """Shuffle join in which keys that hold more than ``hot_share`` of the facts are split.

    At most ``1 / hot_share`` keys can be hot, which bounds the broadcast key list. Only
    lookup rows of hot keys are replicated, once per salt; results equal a plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    keys = list(on)
    counts = durable(facts.groupBy(*keys).count())
    total = counts.agg(F.sum("count")).scalar()
    hot = F.broadcast(counts.where(F.col("count") > total * hot_share).select(*keys, F.lit(True).alias("__hot")))

    # The salt depends on row content and partition, so a retried task repeats it, and
    # equal rows read by different tasks still spread.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in facts.columns]), F.lit(salts))
    salted_facts = facts.withColumn("__spread", spread).join(hot, keys, "left")
    unmatched = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])  # NULL keys never match: spread them too
    salt = F.when(F.col("__hot") | unmatched, F.col("__spread")).otherwise(F.lit(0)).cast("bigint")
    salted_facts = salted_facts.withColumn("__salt", salt)
    last = F.when(F.col("__hot"), F.lit(salts - 1)).otherwise(F.lit(0)).cast("bigint")
    salted_lookup = lookup.join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    joined = salted_facts.drop("__hot", "__spread").join(salted_lookup.drop("__hot"), [*keys, "__salt"], how)
    return joined.drop("__salt")
