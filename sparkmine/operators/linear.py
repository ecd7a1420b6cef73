"""Linear models from one aggregation pass.

Least squares and elastic net depend on the data only through means and covariances.
Spark aggregates those per group; the tiny systems left (features x features) are then
solved next to each group's single row, for any number of groups and penalties at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.functions import distributions as D
from sparkmine.operators.ordering import with_previous
from sparkmine.session import durable


def ols_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """One-feature least squares per group: n, slope, intercept, r2, mse."""
    rest = F.regr_syy(y, x) - F.try_divide(F.pow(F.regr_sxy(y, x), F.lit(2)), F.regr_sxx(y, x))
    return df.groupBy(*by).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.try_divide(rest, F.regr_count(y, x)).alias("mse"),
    )


def elastic_net_path(df: DataFrame, x: str, y: str, reg_params: Sequence[float], elastic_net: float, by: Sequence[str] = ()) -> DataFrame:
    """One-feature elastic net for many penalties in one pass, in closed form.

    The penalty applies to the slope between standardised columns (population
    deviations), so the rows equal ``LinearRegression(regParam, elasticNetParam)`` with
    its normal-equation solver.
    """
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    moments = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_pop(x).alias("vx"),
        F.var_pop(y).alias("vy"), F.covar_pop(x, y).alias("cxy"),
    )
    params = moments.withColumn("reg_param", F.explode(F.array(*[F.lit(float(r)) for r in reg_params])))
    sx, sy = F.sqrt("vx"), F.sqrt("vy")
    pull = F.try_divide(F.col("cxy"), sx * sy)
    strength = F.try_divide(F.col("reg_param"), sy)
    shrunk = F.signum(pull) * F.greatest(F.abs(pull) - strength * elastic_net, F.lit(0.0))
    beta = shrunk / (1 + strength * (1 - elastic_net))
    slope = F.coalesce(beta * F.try_divide(sy, sx), F.lit(0.0))
    fitted = params.withColumn("slope", slope)
    mse = F.col("vy") - 2 * F.col("slope") * F.col("cxy") + F.pow("slope", F.lit(2)) * F.col("vx")
    return fitted.select(
        *by, "reg_param", "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"),
        mse.alias("mse"), (1 - F.try_divide(mse, F.col("vy"))).alias("r2"),
    )


def power_columns(x: str, degree: int) -> dict[str, Column]:
    """``x, x^2, ...`` as products, named ``x``, ``x2``, ``x3``."""
    out, power = {x: F.col(x).cast("double")}, F.col(x).cast("double")
    for d in range(2, degree + 1):
        power = power * F.col(x)
        out[f"{x}{d}"] = power
    return out


def squared_columns(columns: Sequence[str], degree: int = 2) -> dict[str, Column]:
    return {f"{c}_sq": F.pow(F.col(c), F.lit(degree)) for c in columns}


def comoments(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group: n, means, population covariances of features and label."""
    columns = [*features, label]
    complete = df.na.drop(subset=columns).select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [F.covar_pop(columns[i], columns[j]) for i in range(len(columns)) for j in range(i + 1)]
    return complete.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in columns]).alias("mean"), F.array(*pairs).alias("cov")
    )


def _matrix(packed: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.tril_indices(size)] = packed
    return full + np.tril(full, -1).T


def _solve(mean: np.ndarray, cov: np.ndarray, reg_param: float, elastic_net: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the penalised fit from one group's moments."""
    p = len(mean) - 1
    deviation = np.sqrt(np.diag(cov))
    used = [i for i in range(p) if deviation[i] > 0]
    beta = np.zeros(p)
    if used and deviation[p] > 0:
        scale = deviation[used]
        a = cov[np.ix_(used, used)] / np.outer(scale, scale)
        b = cov[used, p] / (scale * deviation[p])
        l1 = reg_param / deviation[p] * elastic_net
        l2 = reg_param / deviation[p] * (1.0 - elastic_net)
        solution = np.linalg.lstsq(a + l2 * np.eye(len(used)), b, rcond=None)[0]
        if l1 > 0:
            for _ in range(100_000):
                change = 0.0
                for j in range(len(used)):
                    pull = b[j] - a[j] @ solution + a[j, j] * solution[j]
                    value = math.copysign(max(abs(pull) - l1, 0.0), pull) / (a[j, j] + l2)
                    change, solution[j] = max(change, abs(value - solution[j])), value
                if change < 1e-12:
                    break
        beta[used] = solution * deviation[p] / scale
    return beta, float(mean[p] - beta @ mean[:p])


def _errors(mean: np.ndarray, cov: np.ndarray, beta: np.ndarray, intercept: float) -> float:
    """Mean squared error of a fit on the rows that the moments describe."""
    p = len(beta)
    bias = mean[p] - intercept - beta @ mean[:p]
    return float(cov[p, p] - 2 * beta @ cov[:p, p] + beta @ cov[:p, :p] @ beta + bias * bias)


def linear_fits(
    moments: DataFrame, n_features: int, specs: Sequence[tuple[float, float]], by: Sequence[str] = (), use: int | None = None
) -> DataFrame:
    """Fit every ``(reg_param, elastic_net)`` of ``specs`` to every row of :func:`comoments`,
    with all features or the first ``use`` of them."""
    chosen = [*range(n_features if use is None else use), n_features]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record in batch.to_dict("records"):
                mean, cov = np.asarray(record["mean"])[chosen], _matrix(np.asarray(record["cov"]), n_features + 1)[np.ix_(chosen, chosen)]
                for reg_param, elastic_net in specs:
                    beta, intercept = _solve(mean, cov, reg_param, elastic_net)
                    mse = _errors(mean, cov, beta, intercept)
                    r2 = 1 - mse / cov[-1, -1] if cov[-1, -1] > 0 else None
                    rows.append([*[record[c] for c in by], reg_param, elastic_net, beta.tolist(), intercept, mse, r2, record["n"]])
            yield pd.DataFrame(rows, columns=[*by, "reg_param", "elastic_net", "coefficients", "intercept", "mse", "r2", "n"])

    groups = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in moments.schema if f.name in by)
    schema = groups + "reg_param double, elastic_net double, coefficients array<double>, intercept double, mse double, r2 double, n bigint"
    return moments.mapInPandas(fit, schema)


def cross_validated_fits(
    moments: DataFrame, n_features: int, specs: Sequence[tuple[float, float]], fold: str = "fold"
) -> DataFrame:
    """Mean held-out RMSE of every spec, from one :func:`comoments` row per fold.

    Training moments of a fold are the merged moments of the other folds, and held-out
    errors follow from the fold's own moments: no pass over the data per fit.
    """

    def merge(parts: list) -> tuple[float, np.ndarray, np.ndarray]:
        n = sum(p[0] for p in parts)
        mean = sum(p[0] * p[1] for p in parts) / n
        cov = sum(p[0] * (p[2] + np.outer(p[1] - mean, p[1] - mean)) for p in parts) / n
        return n, mean, cov

    def validate(folds: pd.DataFrame) -> pd.DataFrame:
        folds = folds.sort_values(fold)
        parts = [(r["n"], np.asarray(r["mean"]), _matrix(np.asarray(r["cov"]), n_features + 1)) for r in folds.to_dict("records")]
        if len(parts) < 2:
            raise ValueError("cross-validation needs rows in at least two folds")
        rows = []
        for reg_param, elastic_net in specs:
            errors = []
            for i, (_, mean, cov) in enumerate(parts):
                _, *train = merge(parts[:i] + parts[i + 1 :])
                errors.append(math.sqrt(_errors(mean, cov, *_solve(*train, reg_param, elastic_net))))
            beta, intercept = _solve(*merge(parts)[1:], reg_param, elastic_net)
            rows.append((reg_param, elastic_net, float(np.mean(errors)), beta.tolist(), intercept))
        return pd.DataFrame(rows, columns=["reg_param", "elastic_net", "avg_rmse", "coefficients", "intercept"])

    schema = "reg_param double, elastic_net double, avg_rmse double, coefficients array<double>, intercept double"
    # One row per fold reaches the single group.
    return moments.groupBy().applyInPandas(validate, schema)


def select_and_test(moments: DataFrame, n_features: int, specs: Sequence[tuple[float, float]], fold: str = "fold", held_out: int = -1) -> DataFrame:
    """Cross-validated choice of a spec, its refit and its errors on rows that no fold ever held, as one step.

    ``moments`` has one :func:`comoments` row per fold and one for the ``held_out`` part. Every spec gets its mean RMSE over the folds and
    its fit on all folds; the best one (smallest RMSE, then the first of ``specs``) also gets ``test_rmse`` and ``test_r2``, which follow
    from the moments of the held-out part alone. The data are read once for all of it.
    """
    choices = cross_validated_fits(moments.where(F.col(fold) != held_out), n_features, specs, fold)
    part = moments.where(F.col(fold) == held_out).select(F.struct("mean", "cov").alias("held")).scalar()
    first = {(float(reg), float(net)): i for i, (reg, net) in reversed(list(enumerate(specs)))}

    def test(choices: pd.DataFrame) -> pd.DataFrame:
        best = min(choices.index, key=lambda i: (choices.avg_rmse[i], first[choices.reg_param[i], choices.elastic_net[i]]))
        out = choices.drop(columns="held").assign(best=choices.index == best, test_rmse=np.nan, test_r2=np.nan)
        held, row = choices.held[best], choices.loc[best]
        if held is not None:
            mean, cov = np.asarray(held["mean"]), _matrix(np.asarray(held["cov"]), n_features + 1)
            mse = max(_errors(mean, cov, np.asarray(row.coefficients), row.intercept), 0.0)
            out.loc[best, "test_rmse"] = math.sqrt(mse)
            out.loc[best, "test_r2"] = 1 - mse / cov[-1, -1] if cov[-1, -1] > 0 else np.nan
        return out

    schema = "reg_param double, elastic_net double, avg_rmse double, coefficients array<double>, intercept double, best boolean, test_rmse double, test_r2 double"
    # One row per spec reaches the single group.
    tested = choices.withColumn("held", part).groupBy().applyInPandas(test, schema)
    return tested.withColumns({c: F.nullif(F.col(c), F.lit(float("nan"))) for c in ("test_rmse", "test_r2")})


def _omnibus(skew: Column, kurtosis: Column, n: Column) -> Column:
    """D'Agostino's K-squared: squared normal scores of the skewness and the kurtosis."""
    one, half = F.lit(1.0), F.lit(0.5)
    y = skew * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    z_skew = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(half * F.log(w2))
    mean, var = 3 * (n - 1) / (n + 1), 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (kurtosis - mean) / F.sqrt(var)
    tilt = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / tilt * (2 / tilt + F.sqrt(one + 4 / (tilt * tilt)))
    z_kurtosis = (1 - 2 / (9 * a) - F.cbrt((1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4))))) / F.sqrt(2 / (9 * a))
    return z_skew * z_skew + z_kurtosis * z_kurtosis


def inference_terms(df: DataFrame, x: str, y: str, order_by: Sequence[str]) -> DataFrame:
    """One-row least-squares report: coefficients, standard errors, t and F values, fit criteria and residual diagnostics
    with their tail probabilities."""
    rows = df.select(*order_by, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")).na.drop()
    base = durable(
        rows.agg(
            F.count(F.lit(1)).alias("n"), F.avg("__x").alias("mx"), F.var_pop("__x").alias("vx"), F.var_pop("__y").alias("vy"),
            F.regr_slope("__y", "__x").alias("slope"), F.regr_intercept("__y", "__x").alias("intercept"),
        )
    )
    line = base.select(F.struct("slope", "intercept")).scalar()
    residuals = rows.select(*order_by, (F.col("__y") - line["intercept"] - line["slope"] * F.col("__x")).alias("e"))
    e = F.col("e")
    steps = with_previous(residuals, order_by, ["e"]).agg(
        F.avg(e * e).alias("m2"), F.avg(e * e * e).alias("m3"), F.avg(e * e * e * e).alias("m4"),
        (F.sum(F.pow(e - F.col("prev_e"), F.lit(2))) / F.sum(e * e)).alias("durbin_watson"),
    )
    one = base.withColumn("__r", steps.select(F.struct("*")).scalar()).select("*", "__r.*")
    n, sse = F.col("n").cast("double"), F.col("n") * F.col("m2")
    s2 = sse / (n - 2)
    se_slope = F.sqrt(s2 / (n * F.col("vx")))
    se_intercept = F.sqrt(s2 * (1 / n + F.col("mx") * F.col("mx") / (n * F.col("vx"))))
    # Explained share from the slope itself: 1 - m2 / vy would cancel when it is tiny.
    r2 = F.col("slope") * F.col("slope") * F.col("vx") / F.col("vy")
    log_likelihood = -n / 2 * (F.log(2 * F.lit(math.pi) * F.col("m2")) + 1)
    skew, kurtosis = F.col("m3") / F.pow("m2", F.lit(1.5)), F.col("m4") / F.pow("m2", F.lit(2))
    jb = n / 6 * (skew * skew + (kurtosis - 3) * (kurtosis - 3) / 4)
    # Singular values of the (1, x) design from its 2x2 cross-product matrix.
    q = F.col("vx") + F.col("mx") * F.col("mx")
    gap = F.sqrt((q - 1) * (q - 1) + 4 * F.col("mx") * F.col("mx"))
    condition = (1 + q + gap) / (2 * F.sqrt(F.col("vx")))
    return one.select(
        "n", "slope", "intercept", se_slope.alias("se_slope"), se_intercept.alias("se_intercept"),
        (F.col("slope") / se_slope).alias("t_slope"), (F.col("intercept") / se_intercept).alias("t_intercept"),
        r2.alias("r2"), (1 - (1 - r2) * (n - 1) / (n - 2)).alias("adj_r2"), F.pow(F.col("slope") / se_slope, F.lit(2)).alias("f_statistic"),
        log_likelihood.alias("log_likelihood"), (4 - 2 * log_likelihood).alias("aic"),
        (2 * F.log(n) - 2 * log_likelihood).alias("bic"), "durbin_watson", skew.alias("skew"), kurtosis.alias("kurtosis"),
        jb.alias("jarque_bera"), _omnibus(skew, kurtosis, n).alias("omnibus"), condition.alias("condition_number"),
    ).withColumns({
        "prob_jb": D.chi2_probability("jarque_bera", "2"), "prob_omnibus": D.chi2_probability("omnibus", "2"),
        "prob_f": D.f_probability("f_statistic", "1", "n - 2"),
    })


def _beta_tail(t: float, dof: float) -> float:
    """Two-sided tail of Student's t: the regularised incomplete beta function at
    ``dof / (dof + t^2)`` by its continued fraction."""
    a, b, x = dof / 2.0, 0.5, dof / (dof + t * t)
    if x >= 1.0:
        return 1.0

    def fraction(a: float, b: float, x: float) -> float:
        value, d, c = 1.0, 1.0 - (a + b) * x / (a + 1.0), 1.0
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        value = d
        for m in range(1, 2000):
            for numerator in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1.0 + numerator * d
                c = 1.0 + numerator / c
                d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
                step = d * (c if abs(c) > 1e-300 else 1e-300)
                value *= step
            if abs(step - 1.0) < 1e-15:
                break
        return value

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * fraction(a, b, x) / a
    return 1.0 - front * fraction(b, a, 1.0 - x) / b


def t_probability(t: float, dof: float) -> float:
    """Two-sided p-value of a t statistic."""
    return _beta_tail(abs(t), dof)


def t_critical(confidence: float, dof: float) -> float:
    """Quantile that leaves ``1 - confidence`` in both tails, by bisection."""
    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if t_probability(middle, dof) > 1 - confidence else (low, middle)
    return (low + high) / 2


def coefficient_table(terms: DataFrame, confidence: float = 0.95) -> DataFrame:
    """``(term, coef, std_err, t, p, low, high)`` from :func:`inference_terms` (one row)."""
    lines = [F.struct(F.lit(term).alias("term"), *[F.col(f"{c}{name}").alias(out) for out, c in (("coef", ""), ("std_err", "se_"), ("t", "t_"))]) for term, name in (("const", "intercept"), ("x1", "slope"))]
    rows = terms.select("n", D.t_critical(confidence, "n - 2").alias("__width"), F.inline(F.array(*lines)))
    reach = F.col("__width") * F.col("std_err")
    return rows.select("term", "coef", "std_err", "t", D.t_probability("t", "n - 2").alias("p"), (F.col("coef") - reach).alias("low"), (F.col("coef") + reach).alias("high"))


def extreme_lines(grid: DataFrame, x: str, coefficients: DataFrame) -> DataFrame:
    """Lowest and highest line over a grid when both coefficients move in their intervals."""
    bounds = {r["term"]: (r["low"], r["high"]) for r in coefficients.collect()}  # two rows
    lines = [F.lit(a) + F.lit(b) * F.col(x) for a in bounds["const"] for b in bounds["x1"]]
    return grid.withColumns({"y_low": F.least(*lines), "y_high": F.greatest(*lines)})


def evaluation_grid(df: DataFrame, x: str, points: int = 100, margin: float = 0.05) -> DataFrame:
    """``points`` values of ``x`` from 5 % below its minimum to 5 % above its maximum."""
    limits = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi")).withColumn("__pad", (F.col("__hi") - F.col("__lo")) * margin)
    numbered = limits.withColumn("id", F.explode(F.sequence(F.lit(0), F.lit(points - 1)).cast("array<bigint>")))
    step = (F.col("__hi") - F.col("__lo") + 2 * F.col("__pad")) / (points - 1)
    return numbered.select("id", (F.col("__lo") - F.col("__pad") + step * F.col("id")).alias(x))


def score_linear(df: DataFrame, features: Sequence[Column], coefficients: Sequence[float], intercept: float) -> Column:
    """Prediction column of a fitted line, for use outside a model object."""
    total = F.lit(float(intercept))
    for feature, weight in zip(features, coefficients):
        total = total + feature * F.lit(float(weight))
    return total
