"""Time-series reports over the daily number of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.dates import periodic_columns
from sparkmine.operators import timeseries as TS
from sparkmine.plans.registry import registrar
from sparkmine.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)

LAGS, PERIOD, BINS = 40, 30, 39

SQL_DAYS = """
    days AS (SELECT unnest(range((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders) + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day),
    s AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS t, coalesce(n, 0)::DOUBLE AS y
          FROM days LEFT JOIN (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1) USING (day))"""


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TS.daily_counts(table(spark, sf_dir, "orders"), "o_orderdate")


@query(f"WITH {SQL_DAYS} SELECT cast(t AS INTEGER) AS t, day, y FROM s")
def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per calendar day, days without orders included."""
    return daily_orders(spark, sf_dir)


@query(f"""WITH {SQL_DAYS}, m AS (SELECT avg(y) AS mu, var_pop(y) * count(*) AS v, count(*) AS n FROM s),
    a AS (SELECT k, sum((p.y - mu) * (q.y - mu)) / any_value(v) AS acf, any_value(n) AS n
          FROM range({LAGS + 1}) r(k), s p, s q, m WHERE q.t = p.t - k GROUP BY k)
    SELECT cast(k AS INTEGER) AS lag, round(acf, 9) AS acf,
           round(CASE WHEN k = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce((SELECT sum(b.acf * b.acf) FROM a b
               WHERE b.k > 0 AND b.k < a.k), 0)) / n) END, 9) AS band FROM a""")
def acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = TS.autocorrelation(daily_orders(spark, sf_dir), LAGS)
    return found.withColumns({"acf": F.round("acf", 9), "band": F.round("band", 9)}).orderBy("lag")


@query(f"""WITH {SQL_DAYS}, 
    moved AS (SELECT k, t + k AS u, y FROM s, range({LAGS}) r(k) WHERE t + k <= (SELECT max(t) FROM s))
    SELECT cast(a.k AS INTEGER) AS i, cast(b.k AS INTEGER) AS j, round(corr(a.y, b.y), 7) AS corr
    FROM moved a JOIN moved b ON a.u = b.u GROUP BY 1, 2""")
def lag_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of the series shifted by 0..39 with itself shifted by 0..39."""
    return TS.lag_correlations(daily_orders(spark, sf_dir), LAGS).withColumn("corr", F.round("corr", 7))


@query(f"""WITH {SQL_DAYS}, n AS (SELECT max(t) AS last FROM s),
    ma AS (SELECT p.t, sum(q.y * CASE WHEN abs(q.t - p.t) = 15 THEN 0.5 ELSE 1.0 END::DOUBLE) / 30 AS trend
           FROM s p JOIN s q ON q.t BETWEEN p.t - 15 AND p.t + 15 GROUP BY p.t HAVING count(*) = 31),
    h AS (SELECT regr_slope(trend, t) AS b, regr_intercept(trend, t) AS a FROM ma WHERE t < 45),
    e AS (SELECT regr_slope(trend, t) AS b, regr_intercept(trend, t) AS a FROM ma, n WHERE t > last - 45),
    tr AS (SELECT s.t, s.y, coalesce(ma.trend, CASE WHEN s.t < 15 THEN h.a + h.b * s.t ELSE e.a + e.b * s.t END) AS trend
           FROM s LEFT JOIN ma ON ma.t = s.t, h, e),
    ph AS (SELECT t % 30 AS phase, avg(y - trend) AS m FROM tr GROUP BY 1)
    SELECT cast(tr.t AS INTEGER) AS t, y, round(trend, 7) AS trend, round(m - (SELECT avg(m) FROM ph), 7) AS seasonal,
           round(y - trend - (m - (SELECT avg(m) FROM ph)), 7) AS resid FROM tr JOIN ph ON ph.phase = tr.t % 30""")
def seasonal_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = TS.seasonal_decompose(daily_orders(spark, sf_dir), PERIOD)
    return parts.withColumns({c: F.round(c, 7) for c in ("trend", "seasonal", "resid")})


@query(f"""WITH {SQL_DAYS}, n AS (SELECT count(*) AS n FROM s)
    SELECT cast(k AS INTEGER) AS k, round(2 / any_value(n)::DOUBLE * sqrt(pow(sum(y * cos(2 * pi() * t / n * k)), 2)
           + pow(sum(y * sin(2 * pi() * t / n * k)), 2)), 8) AS amplitude FROM s, n, range(1, {BINS + 1}) r(k) GROUP BY 1""")
def spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = TS.amplitude_spectrum(daily_orders(spark, sf_dir), BINS)
    return found.withColumn("amplitude", F.round("amplitude", 8))


@query("""
    SELECT o_orderkey, round(sin(2 * pi() * t / 7), 9) AS sin_7, round(cos(2 * pi() * t / 7), 9) AS cos_7,
           round(sin(2 * pi() * t / 365.25::DOUBLE), 9) AS sin_365_25, round(cos(2 * pi() * t / 365.25::DOUBLE), 9) AS cos_365_25
    FROM (SELECT o_orderkey, datediff('day', DATE '1995-01-01', o_orderdate::DATE) AS t FROM orders)""")
def periodic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date"))
    features = {c: F.round(e, 9) for c, e in periodic_columns(days, [7, 365.25]).items()}
    return table(spark, sf_dir, "orders").select("o_orderkey", *[e.alias(c) for c, e in features.items()])
