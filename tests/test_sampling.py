import pytest
from pyspark.sql import functions as F

from sparkmine.operators import sampling as S


def rows_of(spark, n, partitions=3):
    return spark.range(n).select((F.col("id") * 3 + 1).alias("k"), F.concat(F.lit("row"), "id").alias("wide")).repartition(partitions)


@pytest.mark.parametrize("n,k", [(23, 5), (20, 4), (3, 5), (10, 1)])
def test_kfold_sizes_and_order(spark, n, k):
    found = sorted((r["k"], r["fold"]) for r in S.kfold(rows_of(spark, n), ["k"], k).collect())
    sizes = [n // k + (1 if f < n % k else 0) for f in range(k)]
    assert [f for _, f in found] == [f for f, size in enumerate(sizes) for _ in range(size)]


def expected_strata(labels, k):
    """Fold of every row when classes, in order of appearance, are dealt one row at a time."""
    order = list(dict.fromkeys(labels))
    line = [c for c in order for _ in range(labels.count(c))]
    share = {c: [line[f::k].count(c) for f in range(k)] for c in order}
    queues = {c: [f for f in range(k) for _ in range(share[c][f])] for c in order}
    return [queues[c].pop(0) for c in labels]


@pytest.mark.parametrize("k", [3, 10])
@pytest.mark.parametrize("labels", ["bbaabbacab" * 7, "a" * 40 + "b" * 3 + "c", "abc"])
def test_stratified_folds(spark, labels, k):
    rows = [(i * 2, c, "wide") for i, c in enumerate(labels)]
    df = spark.createDataFrame(rows, "id long, c string, w string").repartition(4)
    found = [r["fold"] for r in S.stratified_kfold(df, "id", "c", k).orderBy("id").collect()]
    assert found == expected_strata(list(labels), k)


def test_rows_without_label_are_kept_without_fold(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "id long, c string")
    found = {r["id"]: r["fold"] for r in S.stratified_kfold(df, "id", "c", 2).collect()}
    assert found == {1: 0, 2: None, 3: 1, 4: None}


def test_fixed_split_takes_the_first_rows(spark):
    split = S.fixed_split(rows_of(spark, 33), ["k"], 0.7).orderBy("k").collect()
    assert [r["split"] for r in split] == ["train"] * 23 + ["test"] * 10
    assert {r["split"] for r in S.fixed_split(rows_of(spark, 4), ["k"], 1.0).collect()} == {"train"}


def test_splits_do_not_depend_on_partitions(spark):
    def parts(n):
        df = rows_of(spark, 200, n)
        hashed = S.hash_split(df, "k", {"train": 0.7, "test": 0.3}, seed=1)
        mixed = S.shuffled_split(df, "k", 0.7, seed=3)
        places = S.shuffle_positions(df, "k", seed=3)
        return [sorted(map(str, d.collect())) for d in (hashed, mixed, places)]

    one, seven = parts(1), parts(7)
    assert one == seven
    assert sum("train" in r for r in one[1]) == 140


def test_hash_split_shares(spark):
    df = spark.range(20000)
    counts = {r["split"]: r["count"] for r in S.hash_split(df, "id", {"a": 3, "b": 1}, seed=9).groupBy("split").count().collect()}
    assert sum(counts.values()) == 20000 and abs(counts["a"] - 15000) < 400


def test_random_split_and_sample(spark):
    df = spark.range(1000)
    train, test = S.random_split(df, [0.8, 0.2], seed=42)
    assert train.count() + test.count() == 1000 and train.intersect(test).count() == 0
    assert 200 < S.sample(df, 0.3, 42).count() < 400


def test_order_of_splits_is_by_name_and_without_ties(spark):
    tied = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError):
        S.fixed_split(tied, ["k"], 0.5)
    with pytest.raises(ValueError):
        S.kfold(tied, ["k"], 2)
    assert sorted(r["split"] for r in S.fixed_split(tied, ["k"], 0.75).collect()) == ["test"] + ["train"] * 3
    with pytest.raises(TypeError):
        S.fixed_split(tied, [F.desc("k")], 0.5)
    with pytest.raises(TypeError):
        S.kfold(tied, [F.col("k")], 2)
