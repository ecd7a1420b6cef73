import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.functions import dates as D
from sparkmine.operators import relational as R


def test_title_parts_keep_titles_without_year(spark):
    titles = ["Toy Story (1995)", "Blank (1999)  ", "No Year", "Two (1990) (1991)", ""]
    rows = R.with_title_parts(spark.createDataFrame([(t,) for t in titles], "title string")).collect()
    assert [(r["title"], r["year"]) for r in rows] == [
        ("Toy Story", "1995"), ("Blank", "1999"), ("No Year", ""), ("Two (1990)", "1991"), ("", ""),
    ]


def test_joined_stats_equal_exploded_join(spark):
    items = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (3, ["c"])], "k int, gs array<string>")
    facts = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0), (9, 1.0), (1, None)], "k int, v double")
    genres = items.select("k", F.explode("gs").alias("g"))
    merged = R.joined_stats(genres, facts, "k", "v", ["g"]).orderBy("g").collect()
    plain = R.group_stats(genres.join(facts, "k"), ["g"], "v").orderBy("g").collect()
    assert [tuple(r) for r in merged] == [tuple(r) for r in plain]
    above = R.above_global_average(R.joined_stats(genres, facts, "k", "v", ["g"]), facts, "v").collect()
    assert [r["g"] for r in above] == ["b"]


def test_release_gap_is_null_for_dirty_years(spark):
    rows = [("2001-05-01", "1999"), ("2001-05-01", ""), ("2001-05-01", None), ("1998-01-01", "1999")]
    df = spark.createDataFrame(rows, "d string, y string").select(D.release_gap(F.to_date("d"), F.col("y")).alias("gap"))
    gaps = df.collect()
    assert [r["gap"] for r in gaps] == [2, None, None, -1]
    assert df.where("gap = -1 OR gap IS NULL").count() == 3
    assert df.where("gap != -1 AND gap IS NOT NULL").count() == 1


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.0, 10.0], [3.0, 3.0], [0.1 * i for i in range(101)]])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = R.histogram(df, ["x"], 5).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=5)
    assert sum(r["n"] for r in rows) == len(values) and len(rows) == 5
    assert np.allclose([r["bin_lo"] for r in rows], edges[:-1]) and np.allclose([r["bin_hi"] for r in rows], edges[1:])
    if len(values) < 10:  # values on an edge may fall on either side of it by rounding
        assert [r["n"] for r in rows] == counts.tolist()


def test_weighted_histogram_sums_weights(spark):
    df = spark.createDataFrame([(0, 5), (1, 7), (4, 2)], "x int, w long")
    rows = R.histogram(df, ["x"], 2, weight=F.col("w")).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [12, 2]


def test_multi_hot_from_genre_lists(spark):
    lists = [("p", ["red", "round"]), ("q", ["soft"]), ("r", ["red", "soft"]), ("s", ["wet"]), ("t", [])]
    df = spark.createDataFrame(lists, "title string, genres array<string>")
    values = sorted(r["v"] for r in R.element_values(df, "genres").collect())
    assert values == ["red", "round", "soft", "wet"]
    hot = R.multi_hot(df, "genres", values, "is_").orderBy("title").collect()
    assert [tuple(r)[1:] for r in hot] == [tuple(v in g for v in values) for _, g in lists]
    rest = R.multi_hot(df, "genres", ["red", "wet"], others="rest").orderBy("title").collect()
    assert [r["rest"] for r in rest] == [["round"], ["soft"], ["soft"], [], []]


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 1.0, 4.5), (3.0, 1.0, 6.0)], "a double, c double, y double")
    found = {r["feature"]: r["corr"] for r in R.correlations(df, ["a", "c"], "y").collect()}
    assert found["c"] is None and found["a"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 6])[0, 1])


def test_ordered_concat_is_one_row_per_key(spark):
    rows = [("big", i, f"p{i}") for i in range(25)] + [("small", 2, "b"), ("small", 1, "a"), ("null", 1, None)]
    df = spark.createDataFrame(rows, "k string, seq int, text string").repartition(5)
    for part_rows in (10, 1000):
        found = {r["k"]: (r["n"], r["text"]) for r in R.ordered_concat(df, "k", ["seq"], "text", part_rows=part_rows).collect()}
        assert found == {"big": (25, "\n".join(f"p{i}" for i in range(25))), "small": (2, "a\nb"), "null": (1, "")}


def test_ordered_concat_of_one_hot_key(spark):
    df = spark.range(100_000).select(F.lit("k").alias("k"), F.col("id").alias("seq"), F.col("id").cast("string").alias("text")).repartition(7)
    rows = R.ordered_concat(df, "k", ["seq"], "text").collect()
    assert [tuple(r) for r in rows] == [("k", 100_000, "\n".join(map(str, range(100_000))))]


def test_sorted_labels_are_whole(spark):
    counted = spark.createDataFrame([("u", "b", 7), ("u", "a", 12), ("u", "c", 3), ("v", "a", 2)], "k string, tag string, n long")
    for part_rows in (5, 1000):
        rows = {r["k"]: r["labels"] for r in R.sorted_label_concat(counted, "k", "tag", "n", part_rows=part_rows).collect()}
        assert rows == {"u": " ".join(["a"] * 12 + ["b"] * 7 + ["c"] * 3), "v": "a a"}


def test_max_row_and_distinct(spark):
    df = spark.createDataFrame([(0.5, "x"), (0.9, "y"), (0.9, "z")], "f double, t string")
    assert tuple(R.row_with_max(df, "f", "t").first()) == (0.9, "z")
    assert R.distinct_values(df, "f").count() == 2


def test_date_columns(spark):
    df = spark.createDataFrame([(964982703,)], "timestamp long")
    row = D.with_date_parts(D.with_epoch_datetime(df, "timestamp"), "datetime").first()
    assert row["datetime"] == "2000-07-30 18:45:03" and (row["year"], row["month"], row["day"]) == (2000, 7, 30)
    axis = spark.createDataFrame([(2000, 7)], "year int, month int").select(D.fractional_year().alias("a")).first()["a"]
    assert axis == 2000.5
    now = D.with_current_parts(df).first()
    assert 0 <= now["hour"] <= 23 and now["year"] >= 2024
    waves = df.select(*[c.alias(n) for n, c in D.periodic_columns(F.lit(7), [7, 365.25]).items()])
    assert waves.columns == ["sin_7", "cos_7", "sin_365_25", "cos_365_25"]
    assert waves.first()["cos_7"] == pytest.approx(1.0)
