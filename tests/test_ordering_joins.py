import random

import pytest
from pyspark.sql import functions as F

from sparkmine.operators import joins as J
from sparkmine.operators import ordering as O


def hot_rows(n=3000, seed=5):
    """Rows of which a third belong to one group."""
    rng = random.Random(seed)
    return [(i, "hot" if i % 3 == 0 else f"g{rng.randrange(40)}", rng.randrange(100)) for i in rng.sample(range(n * 10), n)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_index_matches_sorted_position(spark, partitions):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(partitions)
    found = {r["id"]: r["row_index"] for r in O.with_row_index(df, ["id"]).collect()}
    assert found == {r[0]: i for i, r in enumerate(sorted(rows))}
    descending = {r["id"]: r["row_index"] for r in O.with_row_index(df, [F.desc("v"), F.asc("id")]).collect()}
    assert descending == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}


def test_index_and_sums_within_hot_group(spark):
    rows = hot_rows() + [(10**6 + i, None, i) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(5)
    indexed = O.with_row_index(df, ["id"], within=["g"], name="i")
    summed = O.with_running_sums(df, ["id"], {"s": F.col("v")}, within=["g"])
    expected_index, expected_sum, seen = {}, {}, {}
    for row_id, g, v in sorted(rows):
        n, s = seen.get(g, (0, 0))
        expected_index[row_id], expected_sum[row_id] = n, s + v
        seen[g] = (n + 1, s + v)
    assert {r["id"]: r["i"] for r in indexed.collect()} == expected_index
    assert {r["id"]: r["s"] for r in summed.collect()} == expected_sum


def test_empty_table_has_no_positions(spark):
    empty = spark.createDataFrame([], "id long, g string")
    assert O.with_row_index(empty, ["id"]).count() == 0
    assert O.with_row_index(empty, ["id"], within=["g"]).count() == 0


def test_series_slice_bounds(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("t")).repartition(3)
    assert [r["t"] for r in O.series_slice(df, ["t"], 10, 13).orderBy("t").collect()] == [10, 11, 12]
    assert O.series_slice(df, ["t"], 95).count() == 5
    assert [r["position"] for r in O.series_slice(df, ["t"], 98, 500).orderBy("t").collect()] == [98, 99]
    assert O.series_slice(df, ["t"], 200).count() == 0
    assert O.series_slice(df, ["t"], -5, 2).count() == 2


def test_previous_row_crosses_slices(spark):
    df = spark.range(500).repartition(6)
    pairs = {r["id"]: r["prev_id"] for r in O.with_previous(df, ["id"], ["id"]).collect()}
    assert pairs == {i: (i - 1 if i else None) for i in range(500)}


def test_seeded_key_matches_plain_arithmetic(spark):
    def mixed(key, seed):
        first = ((key % 2147483647) * 48271 + seed * 16807 + 11) % 2147483647
        return (first * 69621 + first // 65536) % 2147483647

    keys = [0, 1, 2, 2147483647, 8 * 10**12 + 7]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", O.seeded_key("k", 42).alias("h"))
    assert {r["k"]: r["h"] for r in df.collect()} == {k: mixed(k, 42) for k in keys}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    facts = spark.createDataFrame(hot_rows() + [(-1, None, 0), (-2, None, 0), (-3, "unmatched", 0)], "id long, g string, v int")
    lookup = facts.where("g IS NOT NULL AND g <> 'unmatched'").select("g").distinct().withColumn("w", F.length("g"))
    plain = facts.join(lookup, ["g"], how)
    salted = J.salted_join(facts, lookup, ["g"], how, hot_share=0.1, salts=8)
    assert sorted(map(str, salted.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_lookup_above_the_limit_is_not_broadcast(spark):
    facts = spark.createDataFrame(hot_rows(), "id long, g string, v int")
    lookup = facts.groupBy("g").agg(F.sum("v").alias("s"))
    small, large = J.join_lookup(facts, lookup, ["g"]), J.join_lookup(facts, lookup, ["g"], broadcast_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.select(small.columns).collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [40, 300, 900])
def test_weighted_lookup_is_split_without_loss(spark, how, limit):
    facts = spark.createDataFrame(hot_rows() + [(-1, None, 0), (-2, "unmatched", 0)], "id long, g string, v int")
    lookup = facts.where("g IS NOT NULL AND g <> 'unmatched'").groupBy("g").agg(F.sum("v").alias("s"), F.count("v").alias("w"))
    weighted = J.stored_lookup(lookup, weight="w")
    assert weighted.size > limit
    plain = facts.join(lookup.drop("w"), ["g"], how)
    split = J.join_lookup(facts, weighted, ["g"], how, broadcast_bytes=limit)
    assert sorted(split.columns) == sorted(plain.columns)
    assert sorted(map(str, split.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_salted_join_rejects_other_types(spark):
    with pytest.raises(ValueError):
        J.salted_join(spark.range(1), spark.range(1), ["id"], "full")


def test_one_long_key_does_not_narrow_the_broadcast(spark):
    lookup = spark.createDataFrame([("x" * 5000, 1)] + [(f"k{i}", 9) for i in range(50)], "g string, w int")
    weighted = J.stored_lookup(lookup, weight="w")
    heavy, light = J.heavy_and_light(weighted, 5000)
    assert weighted.size > 5000 and (heavy.count(), light.count()) == (50, 1)
