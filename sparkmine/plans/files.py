"""Tables exported to CSV in the shared folder and read back by the file readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import linear as L
from sparkmine.plans.registry import registrar
from sparkmine.session import checkpoint_root
from sparkmine.sources.files import read_csv, write_csv
from sparkmine.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/csv-{uuid.uuid4().hex}"


@query("SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def csv_explicit_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as four CSV files and read back with their schema."""
    rows, folder = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal"), _folder(spark)
    write_csv(rows, folder, files=4)
    return read_csv(spark, folder, rows.schema)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_inferred_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a tab between fields, types inferred."""
    rows, folder = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), _folder(spark)
    write_csv(rows, folder, sep="\t")
    return read_csv(spark, folder, sep="\t").withColumn("s_suppkey", F.col("s_suppkey").cast(rows.schema["s_suppkey"].dataType))


@query("""
    SELECT l_returnflag, regr_count(l_extendedprice, l_quantity)::BIGINT AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept FROM lineitem WHERE l_quantity >= 10 GROUP BY l_returnflag""")
def gzip_csv_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fit per gzip CSV folder of a list: one reader, the file's part as the group key, a filter on the scan."""
    rows, folder = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice"), _folder(spark)
    rows.write.partitionBy("l_returnflag").option("header", True).option("compression", "gzip").csv(folder)
    parts = [r["l_returnflag"] for r in rows.select("l_returnflag").distinct().collect()]  # three flags
    schema = rows.drop("l_returnflag").schema
    lines = read_csv(spark, [f"{folder}/l_returnflag={p}" for p in parts], schema).where("l_quantity >= 10")
    flagged = lines.withColumn("l_returnflag", F.regexp_extract(F.col("_metadata.file_path"), "l_returnflag=([^/]*)", 1))
    fits = L.ols_fit(flagged, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return fits.select("l_returnflag", "n", F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"))


@query("""
    SELECT o_orderkey, year(current_date) AS this_year, year(current_date) - CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS age FROM orders""")
def order_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years since every order, from the current date's parts."""
    orders, this_year = table(spark, sf_dir, "orders"), F.year(F.current_timestamp()).cast("bigint")
    return orders.select("o_orderkey", this_year.alias("this_year"), (this_year - F.date_format("o_orderdate", "yyyy").cast("int")).alias("age"))
