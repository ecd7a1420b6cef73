"""Regression reports that Spark computes by aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import linear as L
from sparkmine.operators import montecarlo as MC
from sparkmine.operators import sampling as S
from sparkmine.plans.registry import registrar
from sparkmine.plans.sampling import sql_hash_split
from sparkmine.plans.sqlmath import t_tail
from sparkmine.session import durable
from sparkmine.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
query = registrar(QUERIES, ORACLE)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").alias("X"), F.col("l_extendedprice").alias("Y"))


@query("""
    SELECT l_returnflag, regr_count(l_extendedprice, l_quantity)::BIGINT AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 9) AS r2
    FROM lineitem GROUP BY l_returnflag""")
def ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares per group, all groups in one aggregation."""
    fits = L.ols_fit(_lines(spark, sf_dir), "X", "Y", ["l_returnflag"]).drop("mse")
    return _rounded(_rounded(_rounded(fits, 6, "slope"), 5, "intercept"), 9, "r2")


REG_PARAMS = [0.0, 0.3, 10.0, 20.0, 50.0, 100.0]


@query(f"""
    WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS vx,
                      var_pop(l_extendedprice) AS vy, covar_pop(l_quantity, l_extendedprice) AS c FROM lineitem),
    s AS (SELECT *, unnest({REG_PARAMS})::DOUBLE AS reg_param FROM m),
    b AS (SELECT *, sign(c) * greatest(abs(c) / sqrt(vx * vy) - reg_param / sqrt(vy) * 0.8::DOUBLE, 0)
                    / (1 + reg_param / sqrt(vy) * 0.2::DOUBLE) * sqrt(vy / vx) AS slope FROM s)
    SELECT reg_param, round(slope, 5) AS slope, round(my - slope * mx, 4) AS intercept,
           round(1 - (vy - 2 * slope * c + slope * slope * vx) / vy, 8) AS r2 FROM b""")
def elastic_net_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature, many penalties, one pass."""
    fits = L.elastic_net_path(_lines(spark, sf_dir), "X", "Y", REG_PARAMS, 0.8)
    return _rounded(_rounded(_rounded(fits, 5, "slope"), 4, "intercept"), 8, "r2").select("reg_param", "slope", "intercept", "r2")


def _dated_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", days.cast("double").alias("X"), F.col("o_totalprice").alias("Y"))


SQL_INFERENCE = """r AS MATERIALIZED (SELECT o_orderkey AS k, datediff('day', DATE '1995-01-01', o_orderdate::DATE)::DOUBLE AS x, o_totalprice AS y FROM orders),
    b AS (SELECT count(*) AS n, count(*)::DOUBLE AS dn, avg(x) AS mx, var_pop(x) AS vx, var_pop(y) AS vy, sum(x) AS sx, sum(x * x) AS sxx,
                 regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM r),
    e AS (SELECT k, y - intercept - slope * x AS e FROM r, b),
    d AS (SELECT e, lag(e) OVER (ORDER BY k) AS p FROM e),
    q AS (SELECT avg(e * e) AS m2, avg(e * e * e) AS m3, avg(e * e * e * e) AS m4, sum((e - p) * (e - p)) / sum(e * e) AS dw FROM d),
    a AS MATERIALIZED (SELECT *, n * m2 / (n - 2) AS s2, 1 - m2 / vy AS r2, -n / 2.0::DOUBLE * (ln(2 * pi() * m2) + 1) AS ll,
                 m3 / m2 ** 1.5 AS sk, m4 / (m2 * m2) AS ku, sqrt(n * m2 / (n - 2) / (n * vx)) AS se1,
                 sqrt(n * m2 / (n - 2) * (1 / n::DOUBLE + mx * mx / (n * vx))) AS se0 FROM b, q),
    o AS MATERIALIZED (
      SELECT *, ((1 - 2 / (9 * tail)) - cbrt((1 - 2 / tail) / (1 + (ku - 3 * (dn - 1) / (dn + 1)) / sqrt(kv) * sqrt(2 / (tail - 4))))) / sqrt(2 / (9 * tail)) AS zk
      FROM (SELECT *, 6 + 8 / b1 * (2 / b1 + sqrt(1 + 4 / (b1 * b1))) AS tail, asinh(ys / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(sqrt(w2 * w2))) AS zs
        FROM (SELECT *, sk * sqrt((dn + 1) * (dn + 3) / (6 * (dn - 2))) AS ys,
            sqrt(2 * (3 * (dn * dn + 27 * dn - 70) * (dn + 1) * (dn + 3) / ((dn - 2) * (dn + 5) * (dn + 7) * (dn + 9)) - 1)) - 1 AS w2,
            24 * dn * (dn - 2) * (dn - 3) / ((dn + 1) * (dn + 1) * (dn + 3) * (dn + 5)) AS kv,
            6 * (dn * dn - 5 * dn + 2) / ((dn + 7) * (dn + 9)) * sqrt(6 * (dn + 3) * (dn + 5) / (dn * (dn - 2) * (dn - 3))) AS b1 FROM a))),
    limits AS (SELECT 0 AS step, 0.0::DOUBLE AS low, 20.0::DOUBLE AS high UNION ALL
        SELECT step + 1, CASE WHEN tail > 0.05 THEN (low + high) / 2 ELSE low END, CASE WHEN tail > 0.05 THEN high ELSE (low + high) / 2 END
        FROM (SELECT limits.*, """ + t_tail("((low + high) / 2)", "(dn - 2)") + """ AS tail FROM limits, b WHERE step < 50)),
    terms AS (SELECT 'const' AS term, intercept AS coef, se0 AS std_err FROM a UNION ALL SELECT 'x1', slope, se1 FROM a),
    coefs AS MATERIALIZED (SELECT term, coef, std_err, coef / std_err AS t, """ + t_tail("(coef / std_err)", "(dn - 2)") + """ AS p, coef - low * std_err AS low, coef + low * std_err AS high
        FROM terms, b, limits WHERE step = 50)"""


@query(f"""
    WITH RECURSIVE {SQL_INFERENCE}
    SELECT n, round(slope, 7) AS slope, round(intercept, 4) AS intercept, round(se1, 7) AS se_slope, round(se0, 4) AS se_intercept, round(slope / se1, 6) AS t_slope,
           round(r2, 10) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 10) AS adj_r2, round(r2 / (1 - r2) * (n - 2), 6) AS f_statistic,
           round(ll, 3) AS log_likelihood, round(4 - 2 * ll, 3) AS aic, round(2 * ln(n) - 2 * ll, 3) AS bic,
           round(dw, 8) AS durbin_watson, round(sk, 8) AS skew, round(ku, 8) AS kurtosis,
           round(n / 6.0::DOUBLE * (sk * sk + (ku - 3) ** 2 / 4), 4) AS jarque_bera, abs(round(exp(-n / 12.0::DOUBLE * (sk * sk + (ku - 3) ** 2 / 4)), 9)) AS prob_jb,
           round(zs * zs + zk * zk, 4) AS omnibus, abs(round(exp(-(zs * zs + zk * zk) / 2), 9)) AS prob_omnibus,
           round(sqrt((n + sxx + sqrt((n - sxx) ** 2 + 4 * sx * sx)) ** 2 / (4 * (n * sxx - sx * sx))), 4) AS condition_number,
           abs(round((SELECT p FROM coefs WHERE term = 'x1'), 8)) AS prob_f FROM o""")
def ols_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least-squares report with standard errors, residual diagnostics and their tail probabilities."""
    report = L.inference_terms(_dated_prices(spark, sf_dir), "X", "Y", ["o_orderkey"])
    digits = {
        "slope": 7, "intercept": 4, "se_slope": 7, "se_intercept": 4, "t_slope": 6, "r2": 10, "adj_r2": 10, "f_statistic": 6,
        "log_likelihood": 3, "aic": 3, "bic": 3, "durbin_watson": 8, "skew": 8, "kurtosis": 8, "jarque_bera": 4, "prob_jb": 9,
        "omnibus": 4, "prob_omnibus": 9, "condition_number": 4, "prob_f": 8,
    }
    return report.select("n", *[F.round(c, d).alias(c) for c, d in digits.items()])


_CONFIDENCE_DIGITS = {"coef": 6, "std_err": 6, "t": 6, "p": 8, "low": 5, "high": 5}


@query(f"""
    WITH RECURSIVE {SQL_INFERENCE}
    SELECT term, {", ".join(f"round({c}, {d}) AS {c}" for c, d in _CONFIDENCE_DIGITS.items() if c != "p")}, abs(round(p, 8)) AS p FROM coefs""")
def ols_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficient table with p-values and 95 % intervals."""
    found = L.coefficient_table(L.inference_terms(_dated_prices(spark, sf_dir), "X", "Y", ["o_orderkey"]))
    return found.select("term", *[F.round(c, d).alias(c) for c, d in _CONFIDENCE_DIGITS.items()])


@query(f"""
    WITH RECURSIVE {SQL_INFERENCE},
    g AS (SELECT i::BIGINT AS id, lo - 0.05::DOUBLE * (hi - lo) + 1.1::DOUBLE * (hi - lo) / 99 * i AS x FROM (SELECT min(x) AS lo, max(x) AS hi FROM r), range(100) t(i)),
    l AS (SELECT id, x, c.v + s.v * x AS y FROM g, (SELECT unnest([low, high]) AS v FROM coefs WHERE term = 'const') c, (SELECT unnest([low, high]) AS v FROM coefs WHERE term = 'x1') s)
    SELECT id, round(x, 9) AS "X", round(min(y), 3) AS y_low, round(max(y), 3) AS y_high FROM l GROUP BY id, x""")
def ols_extreme_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band between the extreme lines of the coefficient intervals, over the evaluation grid."""
    prices = _dated_prices(spark, sf_dir)
    table_ = L.coefficient_table(L.inference_terms(prices, "X", "Y", ["o_orderkey"]))
    lines = L.extreme_lines(L.evaluation_grid(prices, "X"), "X", table_)
    return lines.select("id", F.round("X", 9).alias("X"), F.round("y_low", 3).alias("y_low"), F.round("y_high", 3).alias("y_high"))


@query("""
    SELECT o_orderkey, o_totalprice AS X, o_totalprice * o_totalprice AS X2, o_totalprice * o_totalprice * o_totalprice AS X3,
           pow(o_totalprice, 2) AS X_sq FROM (SELECT o_orderkey, round(o_totalprice / 100000, 2) AS o_totalprice FROM orders)""")
def poly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") / 100000, 2).alias("X"))
    return orders.select("o_orderkey", *[e.alias(c) for c, e in {**L.power_columns("X", 3), **L.squared_columns(["X"])}.items()])


@query("""
    WITH r AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, regr_slope(l_extendedprice, l_quantity) AS b,
                      regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
    g AS (SELECT i::BIGINT AS id, lo - 0.05::DOUBLE * (hi - lo) + 1.1::DOUBLE * (hi - lo) / 99 * i AS x, a, b FROM r, range(100) t(i))
    SELECT id, round(x, 9) AS "X", round(a + b * x, 5) AS prediction FROM g""")
def prediction_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100 grid points around the data's range and the fitted line on them."""
    lines = _lines(spark, sf_dir)
    line = lines.agg(F.struct(F.regr_slope("Y", "X").alias("b"), F.regr_intercept("Y", "X").alias("a"))).scalar()
    grid = L.evaluation_grid(lines, "X").withColumn("line", line)
    prediction = F.col("line.a") + F.col("line.b") * F.col("X")
    return grid.select("id", F.round("X", 9).alias("X"), F.round(prediction, 5).alias("prediction"))


@query("""
    WITH m AS (SELECT l_returnflag, count(*) AS n, avg(x) AS mx, avg(x * x) AS mz, avg(y) AS my, var_pop(x) AS a, var_pop(x * x) AS d,
                      covar_pop(x, x * x) AS b, covar_pop(x, y) AS c, covar_pop(x * x, y) AS e, var_pop(y) AS v
               FROM (SELECT l_returnflag, l_quantity AS x, l_extendedprice AS y FROM lineitem) GROUP BY l_returnflag),
    f AS (SELECT *, (d * c - b * e) / (a * d - b * b) AS b1, (a * e - b * c) / (a * d - b * b) AS b2 FROM m)
    SELECT l_returnflag, n, round(b1, 4) AS b1, round(b2, 6) AS b2, round(my - b1 * mx - b2 * mz, 3) AS intercept,
           round((b1 * c + b2 * e) / v, 8) AS r2 FROM f""")
def poly2_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quadratic least squares per group."""
    lines = _lines(spark, sf_dir).withColumns(L.power_columns("X", 2))
    fits = L.linear_fits(L.comoments(lines, ["X", "X2"], "Y", ["l_returnflag"]), 2, [(0.0, 0.0)], ["l_returnflag"])
    return fits.select(
        "l_returnflag", "n", F.round(F.col("coefficients")[0], 4).alias("b1"), F.round(F.col("coefficients")[1], 6).alias("b2"),
        F.round("intercept", 3).alias("intercept"), F.round("r2", 8).alias("r2"),
    )


@query()
def poly_order_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r2 and mse of penalised orders 2 and 3 per dataset (return flag), one row each."""
    lines = _lines(spark, sf_dir).withColumns(L.power_columns("X", 3))
    by = ["l_returnflag"]
    moments = durable(L.comoments(lines, ["X", "X2", "X3"], "Y", by))  # one row per dataset
    second = L.linear_fits(moments, 3, [(10.0, 0.8)], by, use=2).withColumn("degree", F.lit(2))
    third = L.linear_fits(moments, 3, [(0.3, 0.8)], by).withColumn("degree", F.lit(3))
    return second.unionByName(third).groupBy(*by).pivot("degree", [2, 3]).agg(F.first("r2").alias("r2"), F.first("mse").alias("mse"))


LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
GRID = [(reg, net) for reg in (0.1, 0.5, 1.0, 2.0, 3.0) for net in (0.0, 0.25, 0.5, 0.75, 1.0)]


FOLDS = {str(i): 0.2 for i in range(5)}
HELD_OUT = {"train": 0.8, "test": 0.2}


def _sql_cross_validation() -> str:
    """The same grid by coordinate descent in a recursive query; errors are measured on the rows themselves."""
    p, names = len(LINE_FEATURES), LINE_FEATURES
    pairs = ", ".join(f"corr({names[i]}, {names[j]}) AS a{i}_{j}" for i in range(p) for j in range(i + 1, p))
    pulls = ", ".join(f"corr({f}, y) AS b{i}, avg({f}) AS m{i}, stddev_pop({f}) AS d{i}" for i, f in enumerate(names))
    sweep = "SELECT * REPLACE (step + 1 AS step) FROM cd WHERE step < 60"
    for j in range(p):
        rest = "".join(f" - a{min(i, j)}_{max(i, j)} * s{i}" for i in range(p) if i != j)
        sweep = f"SELECT * REPLACE (sign(b{j}{rest}) * greatest(abs(b{j}{rest}) - l1, 0) / (1 + l2) AS s{j}) FROM ({sweep})"
    line = "".join(f" + w{i} * {f}" for i, f in enumerate(names))
    return f"""
    WITH RECURSIVE cut AS MATERIALIZED (SELECT {", ".join(names)}, l_extendedprice AS y,
        CASE WHEN {sql_hash_split("l_orderkey", HELD_OUT, 5)} = 'test' THEN -1 ELSE CAST({sql_hash_split("l_orderkey", FOLDS, 42)} AS INTEGER) END AS fold FROM lineitem),
    m AS (SELECT g, avg(y) AS my, stddev_pop(y) AS dy, {pulls}, {pairs} FROM cut, range(-1, 5) r(g) WHERE fold <> g AND fold >= 0 GROUP BY g),
    spec AS (SELECT unnest({[float(r) for r, _ in GRID]})::DOUBLE AS reg, unnest({[float(n) for _, n in GRID]})::DOUBLE AS net),
    cd AS (
        SELECT 0 AS step, m.*, reg, net, reg / dy * net AS l1, reg / dy * (1 - net) AS l2, {", ".join(f"0::DOUBLE AS s{i}" for i in range(p))} FROM m, spec
        UNION ALL {sweep}
    ),
    fit AS (SELECT *, my{"".join(f" - w{i} * m{i}" for i in range(p))} AS b FROM (SELECT *, {", ".join(f"s{i} * dy / d{i} AS w{i}" for i in range(p))} FROM cd WHERE step = 60)),
    err AS (SELECT reg, net, avg(rmse) AS avg_rmse FROM (
        SELECT reg, net, g, sqrt(avg((y - b{line.replace(" + ", " - ")}) ** 2)) AS rmse FROM fit JOIN cut ON fold = g WHERE g >= 0 GROUP BY ALL) GROUP BY ALL),
    top AS (SELECT reg, net FROM err ORDER BY avg_rmse, reg, net LIMIT 1),
    held AS (SELECT reg, net, sqrt(avg((y - b{line.replace(" + ", " - ")}) ** 2)) AS rmse, 1 - avg((y - b{line.replace(" + ", " - ")}) ** 2) / var_pop(y) AS r2
             FROM fit JOIN top USING (reg, net) JOIN cut ON fold = -1 WHERE g = -1 GROUP BY ALL)
    SELECT reg AS reg_param, net AS elastic_net, round(avg_rmse, 4) AS avg_rmse, {", ".join(f"round(w{i}, 4) AS b{i + 1}" for i in range(p))}, round(b, 3) AS intercept,
           held.rmse IS NOT NULL AS best, round(held.rmse, 4) AS test_rmse, round(held.r2, 8) AS test_r2
    FROM fit JOIN err USING (reg, net) LEFT JOIN held USING (reg, net) WHERE g = -1"""


@query(_sql_cross_validation())
def cv_elasticnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold cross-validated 5 x 5 elastic-net grid; the best spec refitted and tested on held-out lines. One pass over the order lines."""
    lines = S.hash_split(table(spark, sf_dir, "lineitem"), "l_orderkey", FOLDS, seed=42, name="fold")
    lines = S.hash_split(lines, "l_orderkey", HELD_OUT, seed=5)
    parts = lines.withColumn("fold", F.when(F.col("split") == "test", -1).otherwise(F.col("fold").cast("int")))
    moments = durable(L.comoments(parts, LINE_FEATURES, "l_extendedprice", ["fold"]))  # one row per fold
    found = L.select_and_test(moments, len(LINE_FEATURES), GRID)
    weights = [F.round(F.col("coefficients")[i], 4).alias(f"b{i + 1}") for i in range(len(LINE_FEATURES))]
    digits = {"avg_rmse": 4, "intercept": 3, "test_rmse": 4, "test_r2": 8}
    return found.select("reg_param", "elastic_net", "best", *weights, *[F.round(c, d).alias(c) for c, d in digits.items()])


_PI_SQL = """
    WITH p AS (SELECT (o_orderkey * 32 + j) % 2147483648 AS i FROM orders, range(32) r(j)),
    q AS (SELECT ((i * 1103515245 + 12345) % 2147483648) / 2147483648::DOUBLE * 2 - 1 AS x,
                 ((i * 22695477 + 1) % 4294967296) / 4294967296::DOUBLE * 2 - 1 AS y FROM p),
    c AS (SELECT count(*) AS points, sum((x * x + y * y < 1)::INTEGER)::BIGINT AS inside FROM q)
    SELECT points, inside, round(inside * 4 / points::DOUBLE, 9) AS pi FROM c"""


@query(_PI_SQL)
def pi_lcg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monte-Carlo pi with 32 repeatable points per order."""
    return _rounded(MC.pi_from_keys(table(spark, sf_dir, "orders"), "o_orderkey", 32), 9, "pi")
