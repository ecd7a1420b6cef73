"""Rating-, genre-, user- and tag-style reports over the order tables.

Items are ``part`` rows (name tokens are their genres), ratings are ``lineitem``
quantities, users are ``customer`` rows, tags are order priorities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.dates import fractional_year, release_gap, with_date_parts, with_epoch_datetime
from sparkmine.operators import relational as R
from sparkmine.operators.ordering import top_k
from sparkmine.plans.registry import registrar
from sparkmine.session import durable
from sparkmine.sources.tables import register_views, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


query = registrar(QUERIES, ORACLE)


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("rating"), F.col("l_shipdate").alias("rated_at")
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"), F.split("p_name", " ").alias("genres"), "p_brand"
    )


def _genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).select("item_id", F.explode("genres").alias("genre"))


def _genre_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.joined_stats(_genres(spark, sf_dir), _ratings(spark, sf_dir), "item_id", "rating", ["genre"])


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


_GENRE_SQL = """
    SELECT g.genre, min(l_quantity) AS min_rating, round(avg(l_quantity), 6) AS avg_rating,
           max(l_quantity) AS max_rating, count(l_quantity) AS rating_cnt
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre FROM part) g
    JOIN lineitem ON l_partkey = g.p_partkey
    GROUP BY g.genre"""


@query(f"""
    SELECT genre, avg_rating, rating_cnt FROM ({_GENRE_SQL}
    HAVING avg(l_quantity) > (SELECT avg(l_quantity) FROM lineitem))""")
def genre_above_global_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genres rated above the global average, as SQL text over temp views."""
    register_views(spark, sf_dir, ["part", "lineitem"])
    return spark.sql("""
        WITH per_item AS (
            SELECT l_partkey, sum(l_quantity) AS total, count(l_quantity) AS cnt FROM lineitem GROUP BY l_partkey
        ), genres AS (
            SELECT p_partkey, explode(split(p_name, ' ')) AS genre FROM part
        )
        SELECT genre, round(sum(total) / sum(cnt), 6) AS avg_rating, sum(cnt) AS rating_cnt
        FROM genres JOIN per_item ON p_partkey = l_partkey
        GROUP BY genre
        HAVING sum(total) / sum(cnt) > (SELECT avg(l_quantity) FROM lineitem)
        ORDER BY avg_rating DESC, genre""")


@query(ORACLE["genre_above_global_sql"])
def genre_above_global_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report in DataFrame form."""
    above = R.above_global_average(_genre_stats(spark, sf_dir), _ratings(spark, sf_dir), "rating")
    return _rounded(above, "avg_rating").select("genre", "avg_rating", "rating_cnt").orderBy(F.desc("avg_rating"), "genre")


@query(_GENRE_SQL)
def genre_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_genre_stats(spark, sf_dir), "avg_rating").orderBy("genre")


@query(f"SELECT * FROM ({_GENRE_SQL}) ORDER BY avg_rating DESC, genre LIMIT 3")
def genre_top3_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_rounded(_genre_stats(spark, sf_dir), "avg_rating"), 3, F.desc("avg_rating"), F.asc("genre"))


@query(f"SELECT * FROM ({_GENRE_SQL}) ORDER BY rating_cnt DESC, genre LIMIT 3")
def genre_top3_cnt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_rounded(_genre_stats(spark, sf_dir), "avg_rating"), 3, F.desc("rating_cnt"), F.asc("genre"))


_TITLE_SQL = """
    SELECT p_partkey AS item_id, p_name AS title, min(l_quantity) AS min_rating, round(avg(l_quantity), 6) AS avg_rating,
           max(l_quantity) AS max_rating, count(l_quantity) AS rating_cnt
    FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_name"""


def _title_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.joined_stats(_items(spark, sf_dir), _ratings(spark, sf_dir), "item_id", "rating", ["item_id", "title"])


@query(_TITLE_SQL)
def title_rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item: grouped by id and title, so namesakes stay apart."""
    return _rounded(_title_stats(spark, sf_dir), "avg_rating").orderBy(F.desc("rating_cnt"), "item_id")


@query("""
    SELECT p_name AS title, min(l_quantity) AS min_rating, round(avg(l_quantity), 6) AS avg_rating,
           max(l_quantity) AS max_rating, count(l_quantity) AS rating_cnt
    FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_name""")
def title_rating_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped by title only, which merges items of one name."""
    by_name = R.joined_stats(_items(spark, sf_dir), _ratings(spark, sf_dir), "item_id", "rating", ["title"])
    return _rounded(by_name, "avg_rating").orderBy(F.desc("rating_cnt"), "title")


@query(f"SELECT item_id, rating_cnt FROM ({_TITLE_SQL}) WHERE avg_rating >= 26 AND rating_cnt >= 30")
def title_rating_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chained predicates on columns that the result does not show."""
    return _title_stats(spark, sf_dir).where("round(avg_rating, 6) >= 26").where("rating_cnt >= 30").select("item_id", "rating_cnt")


_HIST_SQL = """
    WITH v AS ({values}), r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    b AS (SELECT least(cast(floor((x - lo) / ((hi - lo) / {bins}.0::DOUBLE)) AS INTEGER), {bins} - 1) AS bin, sum(w) AS n
          FROM v, r GROUP BY 1)
    SELECT '{name}' AS name, cast(i AS INTEGER) AS bin, round(lo + (hi - lo) / {bins}.0::DOUBLE * i, 6) AS bin_lo,
           round(lo + (hi - lo) / {bins}.0::DOUBLE * (i + 1), 6) AS bin_hi, cast(coalesce(n, 0) AS BIGINT) AS n
    FROM r, range({bins}) q(i) LEFT JOIN b ON b.bin = i"""


@query(_HIST_SQL.format(
    values="SELECT avg(l_quantity) AS x, 1 AS w FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_partkey",
    bins=50, name="avg_rating"))
def rating_hist50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50-bin histogram of the items' average ratings."""
    averages = durable(_title_stats(spark, sf_dir).select("avg_rating"))
    return _rounded(R.histogram(averages, ["avg_rating"], 50), "bin_lo", "bin_hi")


@query(" UNION ALL ".join(
    "SELECT * FROM (" + _HIST_SQL.format(values=f"SELECT {c} AS x, 1 AS w FROM lineitem", bins=20, name=c) + ")"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def numeric_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20-bin histograms of all numeric measures of a table at once."""
    lines = table(spark, sf_dir, "lineitem")
    return _rounded(R.histogram(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 20), "bin_lo", "bin_hi")


def _gap_counts(spark: SparkSession, sf_dir: str, exploded: bool) -> DataFrame:
    """Rated-minus-released years. Ratings are counted per item and year before the join;
    the exploded form weighs an item by its number of genres instead of exploding it."""
    yearly = _ratings(spark, sf_dir).groupBy("item_id", F.year("rated_at").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    digits = F.regexp_extract("p_brand", r"(\d{2})$", 1)
    year_text = F.when(digits == "", F.lit("")).otherwise(F.concat(F.lit("19"), digits))
    items = _items(spark, sf_dir).select("item_id", year_text.alias("year"), F.size("genres").cast("bigint").alias("n_genres"))
    weight = F.col("n") * F.col("n_genres") if exploded else F.col("n")
    gap = release_gap(F.make_date("y", F.lit(1), F.lit(1)), F.col("year"))
    return items.join(yearly, "item_id").groupBy(gap.alias("gap")).agg(F.sum(weight).alias("count"))


def _gap_sql(exploded: bool) -> str:
    weight = "sum(len(string_split(p_name, ' ')))" if exploded else "count(*)"
    return f"""
    SELECT cast(year(l_shipdate) - try_cast('19' || nullif(regexp_extract(p_brand, '([0-9]{{2}})$', 1), '') AS INTEGER) AS INTEGER) AS gap,
           cast({weight} AS BIGINT) AS "count"
    FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1"""


@query(_gap_sql(False))
def release_gap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gap_counts(spark, sf_dir, exploded=False).orderBy("gap")


@query(_gap_sql(True))
def release_gap_counts_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gap_counts(spark, sf_dir, exploded=True).orderBy("gap")


@query(f"SELECT * FROM ({_gap_sql(False)}) WHERE gap = 80 OR gap IS NULL")
def release_gap_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gap_counts(spark, sf_dir, exploded=False).where("gap = 80 OR gap IS NULL")


@query(_HIST_SQL.format(
    values=f"""SELECT gap AS x, "count" AS w FROM ({_gap_sql(True)}) WHERE gap != 80 AND gap IS NOT NULL""", bins=50, name="gap"))
def gap_weighted_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted 50-bin histogram of the counted gaps."""
    counted = durable(_gap_counts(spark, sf_dir, exploded=True).where("gap != 80 AND gap IS NOT NULL"))
    return _rounded(R.histogram(counted, ["gap"], 50, weight=F.col("count")), "bin_lo", "bin_hi")


# The 16 name tokens of the generated items; any other token would be found in the array of others.
_GENRES = "anvil blue bolt cold gear gizmo hot large new old plate red ring rod small widget".split()


@query("SELECT p_partkey AS item_id, " + ", ".join(f"list_contains(string_split(p_name, ' '), '{g}') AS \"{g}\"" for g in _GENRES) + """,
    array_to_string(list_sort(list_distinct(list_filter(string_split(p_name, ' '), lambda g: NOT list_contains(""" + repr(_GENRES) + """, g)))), ' ') AS others FROM part""")
def genre_multihot(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir).select("item_id", "genres")
    return R.multi_hot(items, "genres", _GENRES, others="others").withColumn("others", F.array_join("others", " "))


@query("""
    SELECT p_partkey AS item_id, CASE WHEN code = '' THEN p_brand ELSE 'Brand' END AS title, code
    FROM (SELECT p_partkey, p_brand, regexp_extract(p_brand, '^Brand#([0-9]{2})$', 1) AS code FROM part)""")
def brand_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract, replace, drop and rename columns; a missing match gives ''."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    extracted = parts.withColumns({
        "code": F.regexp_extract("p_brand", r"^(Brand)#(\d{2})$", 2),
        "title2": F.regexp_extract("p_brand", r"^(Brand)#(\d{2})$", 1),
    })
    named = extracted.withColumn("title2", F.when(F.col("code") == "", F.col("p_brand")).otherwise(F.col("title2")))
    return named.drop("p_brand").withColumnRenamed("title2", "title").withColumnRenamed("p_partkey", "item_id")


@query("""
    SELECT cast(year(l_shipdate) AS INTEGER) AS year, cast(month(l_shipdate) AS INTEGER) AS month, count(*) AS "count",
           concat(year(l_shipdate), '-', month(l_shipdate)) AS label,
           round(year(l_shipdate) + (month(l_shipdate) - 1) / 12.0::DOUBLE, 6) AS axis
    FROM lineitem GROUP BY year(l_shipdate), month(l_shipdate)""")
def year_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = with_date_parts(table(spark, sf_dir, "lineitem").select("l_shipdate"), "l_shipdate")
    label = F.concat(F.col("year"), F.lit("-"), F.col("month"))
    counted = dated.groupBy("year", "month").count()
    return counted.withColumns({"label": label, "axis": F.round(fractional_year(), 6)}).orderBy("year", "month")


@query("""
    SELECT c_name AS email, round(avg(o_totalprice), 7) AS avg_rating, count(o_totalprice) AS "count"
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name""")
def user_rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("email"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("rating"))
    joined = R.joined_stats(users, orders, "user_id", "rating", ["email"])
    report = joined.select("email", F.round("avg_rating", 7).alias("avg_rating"), F.col("rating_cnt").alias("count"))
    return report.orderBy(F.desc("avg_rating"), "email")


@query("""
    SELECT c_name AS email, string_agg(o_orderpriority, ' ' ORDER BY o_orderpriority) AS labels
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name""")
def user_tags_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tags of a user in one text. Users and tags are joined in SQL after counting."""
    register_views(spark, sf_dir, ["customer", "orders"])
    counted = spark.sql("""
        SELECT u.c_name AS email, t.tag, sum(t.n) AS n
        FROM customer u
        JOIN (SELECT o_custkey, o_orderpriority AS tag, count(*) AS n FROM orders GROUP BY ALL) t ON u.c_custkey = t.o_custkey
        GROUP BY ALL""")
    return R.sorted_label_concat(counted, "email", "tag", "n")


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_name LIKE 're%' AND p_size >= 20")
def like_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix and range predicates; both reach the Parquet scan."""
    parts = table(spark, sf_dir, "part").where(F.col("p_name").like("re%") & (F.col("p_size") >= 20))
    return parts.select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("""
    SELECT o_orderkey, cast(o_orderdate AS DATE) AS day, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL""")
def notnull_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_totalprice IS NOT NULL")
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")


@query("SELECT DISTINCT lang AS author, source AS work FROM documents")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("author"), F.col("source").alias("work")).distinct()


@query("SELECT DISTINCT event_type FROM events")
def unique_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.distinct_values(table(spark, sf_dir, "events"), "event_type")


@query("SELECT lang AS author, count(*) AS \"count\" FROM documents GROUP BY lang")
def docs_per_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("author")).count()


@query("SELECT lang AS author, round(avg(length(text)), 6) AS avg_text_length FROM documents GROUP BY lang")
def avg_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("content_length", F.length("text"))
    return documents.groupBy(F.col("lang").alias("author")).agg(F.round(F.avg("content_length"), 6).alias("avg_text_length"))


@query("""
    SELECT o_orderkey, cast(floor(epoch(o_orderdate)) AS BIGINT) AS "timestamp",
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS datetime, cast(year(o_orderdate) AS INTEGER) AS year,
           cast(month(o_orderdate) AS INTEGER) AS month, cast(day(o_orderdate) AS INTEGER) AS day,
           cast(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS parsed,
           cast(epoch(o_orderdate) AS DOUBLE) AS unixdate,
           CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS passed
    FROM orders""")
def epoch_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds, date-time text, date parts, parsed dates and an IF label."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("at"))
    epoch = orders.withColumn("timestamp", F.unix_timestamp("at"))
    parts = with_date_parts(with_epoch_datetime(epoch, "timestamp"), "at")
    return parts.select(
        "o_orderkey", "timestamp", "datetime", "year", "month", "day",
        F.to_date(F.date_format("at", "yyyy-MM-dd"), "yyyy-MM-dd").alias("parsed"),
        F.col("timestamp").cast("double").alias("unixdate"),
        F.expr("if(o_totalprice >= 250000, 1, 0)").alias("passed"),
    )


@query("""
    SELECT conv_id, count(*) AS n, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def ordered_conversation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of a conversation appended in turn order."""
    return R.ordered_concat(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], "text")


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 6) AS corr FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def pearson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of each feature with the label, one pass for all features."""
    found = R.correlations(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return _rounded(found, "corr")


@query("SELECT o_totalprice, o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1")
def max_price_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row that holds a column's maximum, found without comparing floats for equality."""
    return R.row_with_max(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey")
