"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight that changes linearly over training time t in [0, 1], from ``(1 + tilt)`` to ``(1 - tilt)``
times its weight. The integral over all of training gives the source's target; the integral up to t is the share of the
target that is demanded by then. Documents of a source are queued in a seeded order, the queue is repeated up to
``MAX_REPEATS`` times, and the place of a document in the queue is turned into a training position by inverting the
demand. Range-sorting all copies by position gives the training order.

Targets: all words are shared out by weight; a source stops at ``MAX_REPEATS`` times its own size and the excess is
shared out again by weight until none is above. This ends at ``min(limit, level * weight)`` with one level for all
sources, which is found from the sorted ratios of limit to weight.

Scale: only keys, sources and sizes are shuffled. Queue places are running sums over range slices, so a source or a row
repeated by a third of the table is spread over many tasks. Sources are ranked and summed over slices as well. Texts
meet their places in one join; only texts that occur in several equal rows are stored to number these rows.

Edge cases: NULL text has size 0 and is not taken; the NULL source comes last. Every row has its own place in the queue, so
of equal rows some may be taken and others not. No rows give no rows. Other columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.shared import attach, stored
from sparkmine.operators.ordering import with_row_index, with_running_sums
from sparkmine.session import durable

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
TILT = 0.5


def word_count(text: Column) -> Column:
    """Number of runs of characters that are no ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def mix_key(docs: DataFrame, seed: int) -> Column:
    """Seeded sort key from id, source and text; any engine repeats it."""
    parts = [F.coalesce(docs[c].cast("string"), F.lit("")) for c in ("doc_id", "source", "text")]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target, tilt`` from ``(source, source_size)``."""
    by_name = F.col("source").asc_nulls_last()
    rows = with_row_index(sizes, [by_name], name="place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int")).cast("double")
    rows = rows.withColumn("weight", weight).withColumn("tilt", F.when(F.col("place") % 2 == 0, TILT).otherwise(-TILT))
    rows = rows.withColumn("ratio", repeats * F.col("source_size") / F.col("weight"))
    # With the sources of smaller ratio at their limit, the others get `level * weight`.
    sums = {"spent": F.col("source_size") * repeats, "closed": F.col("weight"), "size": F.col("source_size")}
    rows = durable(with_running_sums(rows, ["ratio", by_name], sums, inclusive=False, totals=["all_spent", "all_weight", "all_size"]))
    own = (F.col("all_size") - F.col("spent")) / (F.col("all_weight") - F.col("closed"))
    level = rows.agg(F.max(F.when(F.col("ratio") >= own, own))).scalar()
    limit = (F.col("source_size") * repeats).cast("double")
    target = F.when(F.col("ratio") < F.col("level"), limit).otherwise(F.col("level") * F.col("weight"))
    return rows.withColumn("level", level).select("source", "source_size", target.alias("target"), "tilt")


def _time(share: Column, tilt: Column) -> Column:
    """When a source has been given ``share`` of its target: the inverse of ``(1 + tilt) t - tilt t^2``."""
    root = F.sqrt(F.greatest((1 + tilt) * (1 + tilt) - 4 * tilt * share, F.lit(0.0)))
    return F.least(F.greatest((1 + tilt - root) / (2 * tilt), F.lit(0.0)), F.lit(1.0))


def queue(docs: DataFrame, seed: int = 0, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``key, doc_id, source, size, before, source_size, target, tilt``: every row's place in the queue of its source, in words."""
    base = docs.select(mix_key(docs, seed).alias("key"), docs["doc_id"].cast("bigint").alias("doc_id"), "source", word_count(docs["text"]).alias("size"))
    # Stored with a number per row, so that equal rows have places of their own.
    base = durable(base.withColumns({"row": F.monotonically_increasing_id(), "group": F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))}))
    targets = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    targets = targets.withColumn("group", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).drop("source")
    queued = with_running_sums(base, ["key", "row"], {"before": F.col("size")}, within=["group"], inclusive=False)
    return attach(queued, targets, "group", "inner").drop("group", "row")


def _turns(repeats: int) -> Column:
    """Where the row's words begin in every round of the queue."""
    return F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda e: F.col("before") + e * F.col("source_size"))


def taken_words(repeats: int = MAX_REPEATS) -> Column:
    quota = F.floor("target").cast("bigint")
    return F.aggregate(_turns(repeats), F.lit(0).cast("bigint"), lambda total, s: total + F.greatest(F.least(s + F.col("size"), quota) - s, F.lit(0)))


def positions(repeats: int = MAX_REPEATS) -> Column:
    """Training times of a row's copies: the times at which its source's demand reaches them."""
    used = F.filter(_turns(repeats), lambda s: (s < F.floor("target")) & (F.col("size") > 0))
    return F.transform(used, lambda s: _time(s / F.col("target"), F.col("tilt")))


def mix(docs: DataFrame, seed: int = 0, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, positions``, one row per input row, in order of the first position.

    ``taken`` counts the words that the mix takes, repeats included; ``positions`` are the training times of
    the copies, the first one first. Rows that are not taken have none and come last.
    """
    places = queue(docs, seed, weights, repeats).withColumns({"taken": taken_words(repeats), "positions": positions(repeats)})
    rows = places.select("doc_id", "source", "size", "source_size", "target", "taken", "positions")
    return rows.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents as often as the mix takes them, range-sorted by training position.

    Adds ``position`` (time in [0, 1]) and ``copy`` (0 for the first); input columns of these names are replaced.
    """
    docs = docs.drop("position", "copy")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), mix_key(docs, seed).alias("key"), docs["doc_id"].alias("order_id"))
    others = [F.first(c).alias(c) for c in ("size", "source_size", "target", "tilt")]
    keys = stored(queue(docs, seed).groupBy("key").agg(F.min("before").alias("before"), F.count(F.lit(1)).alias("rows"), *others))
    placed = whole.join(keys.hinted(), "key")
    # Equal rows stand one after the other in the queue; which is which does not matter, but each needs its number.
    equal = durable(placed.where(F.col("rows") > 1).withColumn("number", F.monotonically_increasing_id()))
    equal = with_row_index(equal, ["number"], within=["key"], name="nth")
    equal = equal.withColumn("before", F.col("before") + F.col("nth") * F.col("size")).select(placed.columns)
    every = placed.where(F.col("rows") == 1).unionByName(equal)
    copies = every.select("doc", "order_id", F.posexplode(positions()).alias("copy", "position"))
    return copies.orderBy("position", "order_id").select("doc.*", "copy", "position")
