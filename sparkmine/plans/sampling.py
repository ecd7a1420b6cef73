"""Splits, folds, shuffles and slices of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import ordering as O
from sparkmine.operators import sampling as S
from sparkmine.plans.registry import registrar
from sparkmine.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)


def sql_seeded_key(key: str, seed: int) -> str:
    first = f"(({key} % 2147483647) * 48271 + {seed * 16807 + 11}) % 2147483647"
    return f"(({first}) * 69621 + cast(floor(({first}) / 65536) AS BIGINT)) % 2147483647"


def sql_hash_split(key: str, weights: dict[str, float], seed: int) -> str:
    """CASE expression of the same cuts as :func:`sparkmine.operators.sampling.hash_split`."""
    total, reached, cases = sum(weights.values()), 0.0, ""
    *parts, last = weights.items()
    for part, weight in parts:
        reached += weight / total
        cases += f" WHEN {sql_seeded_key(key, seed)} < {int(reached * 2147483647)} THEN '{part}'"
    return f"CASE{cases} ELSE '{last[0]}' END"


def sql_stratified_folds(k: int) -> str:
    """(doc_id, lang, fold): every class takes the residues of its places in the line."""
    return f"""(
    WITH placed AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents),
    cls AS (SELECT lang, count(*) AS n, min(row_no) AS seen FROM placed GROUP BY lang),
    line AS (SELECT lang, n, sum(n) OVER (ORDER BY seen) - n AS start FROM cls),
    ranked AS (SELECT p.*, row_number() OVER (PARTITION BY lang ORDER BY row_no) - 1 AS r FROM placed p),
    dealt AS (SELECT r.lang, cast((l.start + r.r) % {k} AS INTEGER) AS fold,
                     row_number() OVER (PARTITION BY r.lang ORDER BY (l.start + r.r) % {k}) - 1 AS r
              FROM ranked r JOIN line l ON r.lang = l.lang)
    SELECT ranked.doc_id, ranked.lang, dealt.fold FROM ranked JOIN dealt ON ranked.lang = dealt.lang AND ranked.r = dealt.r)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey")


@query(f"""
    SELECT o_orderkey, CASE WHEN {sql_seeded_key("o_orderkey", 123)} < cast(floor(0.7::DOUBLE * 2147483647) AS BIGINT)
           THEN 'train' ELSE 'test' END AS split FROM orders""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.hash_split(_orders(spark, sf_dir), "o_orderkey", {"train": 0.7, "test": 0.3}, seed=123)


@query("""
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(count(*) OVER () * 0.7::DOUBLE)
           THEN 'train' ELSE 'test' END AS split FROM orders""")
def fixed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fixed_split(_orders(spark, sf_dir), ["o_orderkey"], 0.7)


@query(f"""
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {sql_seeded_key("o_orderkey", 3)}, o_orderkey)
           <= floor(count(*) OVER () * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM orders""")
def shuffled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shuffled_split(_orders(spark, sf_dir), "o_orderkey", 0.7, seed=3)


@query(f"""
    SELECT o_orderkey, row_number() OVER (ORDER BY {sql_seeded_key("o_orderkey", 1)}, o_orderkey) - 1 AS position FROM orders""")
def shuffle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shuffle_positions(_orders(spark, sf_dir), "o_orderkey", seed=1)


@query("""
    SELECT o_orderkey, cast(CASE WHEN r < m * (q + 1) THEN floor(r / (q + 1)) ELSE floor((r - m) / q) END AS INTEGER) AS fold
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r, cast(floor(count(*) OVER () / 10) AS BIGINT) AS q,
                 count(*) OVER () % 10 AS m FROM orders)""")
def kfold_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.kfold(_orders(spark, sf_dir), ["o_orderkey"], 10)


@query(f"SELECT doc_id, lang, fold FROM {sql_stratified_folds(10)}")
def stratified_kfold_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return S.stratified_kfold(documents, "doc_id", "lang", 10)


@query("""
    SELECT o_orderkey, o_totalprice, position FROM (
        SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders)
    WHERE position >= 100 AND position < 5000""")
def series_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions [100, 5000) of the orders in date order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return O.series_slice(orders, ["o_orderdate", "o_orderkey"], 100, 5000).drop("o_orderdate")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey OFFSET 200")
def offset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows after the first 200 of a total order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return O.series_slice(orders, ["o_orderkey"], 200).drop("position")


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {sql_seeded_key('o_orderkey', 42)} < {int(0.3 * 2147483647)}")
def shuffle_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded sample of the orders in seeded shuffle order, the same on any partitioning."""
    sampled = S.sample(table(spark, sf_dir, "orders"), 0.3, seed=42, key="o_orderkey")
    return O.shuffled(sampled.select("o_orderkey", "o_totalprice"), "o_orderkey", seed=1)


RANDOM_PARTS = {"train": 0.8, "test": 0.2}


@query(f"""
    SELECT {sql_hash_split("o_orderkey", RANDOM_PARTS, 42)} AS split, count(*) AS "count", min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders GROUP BY split""")
def random_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and key ranges of a seeded random split of the orders, the same on any partitioning."""
    parts = S.hash_split(_orders(spark, sf_dir), "o_orderkey", RANDOM_PARTS, seed=42).groupBy("split")
    return parts.agg(F.count(F.lit(1)).alias("count"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
