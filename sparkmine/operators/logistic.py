"""Logistic regression by Newton steps: every step is one aggregate of weighted moments.

The fit minimises ``mean(log loss) + reg_param / 2 * sum((coefficient * deviation)^2)`` (sample deviations, free
intercept), so it ends at the optimum of a ridge-penalised solver with standardised features, whatever that solver's steps.
Only ``(features + 1)^2`` sums reach the driver per step; the rows stay in Spark.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Logistic:
    """Fitted coefficients in the units of the features, and how the fit went."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    steps: int
    loss: float
    threshold: float = 0.5

    def logit(self) -> Column:
        """NULL where a feature is missing."""
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            total = total + _number(name) * F.lit(weight)
        return F.when(complete(self.features), total)

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.logit()))

    def score(self, df: DataFrame, probability: str = "p1", prediction: str = "prediction") -> DataFrame:
        """All rows with probability and class; both NULL where a feature is missing."""
        scored = df.withColumn(probability, self.probability())
        return scored.withColumn(prediction, (F.col(probability) > self.threshold).cast("double"))


def _number(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def complete(features: Sequence[str]) -> Column:
    """Whether a row has a finite number in every feature."""
    return reduce(Column.__and__, [F.coalesce(F.abs(_number(f)) < float("inf"), F.lit(False)) for f in features])


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, reg_param: float = 0.1, tol: float = 1e-10, max_steps: int = 100) -> Logistic:
    """Fit on the rows with a 0/1 label and finite features; raises if the steps do not settle (no optimum, e.g. separable classes without penalty)."""
    names, y = list(features), F.col(f"`{label}`").cast("double")
    rows = df.where(complete(names) & y.isNotNull()).select(y.alias("y"), *[_number(f).alias(f"x{j}") for j, f in enumerate(names)])
    size = len(names)
    found = rows.agg(F.count(F.lit(1)).alias("n"), *[f(f"x{j}").alias(f"{f.__name__}{j}") for j in range(size) for f in (F.avg, F.stddev_samp)]).first()
    if not found["n"]:
        raise ValueError("no labelled row with all features")
    mean = [found[f"avg{j}"] for j in range(size)]
    deviation = [found[f"stddev_samp{j}"] or 0.0 for j in range(size)]
    used = [j for j in range(size) if deviation[j] > 0]  # a constant feature keeps weight 0
    columns = [F.lit(1.0), *[(F.col(f"x{j}") - mean[j]) / deviation[j] for j in used]]
    penalty = reg_param * np.diag([0.0, *[1.0] * len(used)])

    def moments(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and curvature at ``beta``."""
        z = rows.select("y", *[c.alias(f"z{i}") for i, c in enumerate(columns)])
        eta = reduce(Column.__add__, [F.col(f"z{i}") * F.lit(float(b)) for i, b in enumerate(beta)])
        loss = F.greatest(eta, F.lit(0.0)) - F.col("y") * eta + F.log1p(F.exp(-F.abs(eta)))
        z = z.withColumns({"p": 1 / (1 + F.exp(-eta)), "loss": loss})
        w = F.col("p") * (1 - F.col("p"))
        pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
        sums = [F.avg("loss").alias("loss"), *[F.avg((F.col("p") - F.col("y")) * F.col(f"z{i}")).alias(f"g{i}") for i in range(len(columns))]]
        row = z.agg(*sums, *[F.avg(w * F.col(f"z{i}") * F.col(f"z{j}")).alias(f"h{i}_{j}") for i, j in pairs]).first()
        gradient = np.array([row[f"g{i}"] for i in range(len(columns))]) + penalty @ beta
        curvature = np.zeros((len(columns),) * 2)
        for i, j in pairs:
            curvature[i, j] = curvature[j, i] = row[f"h{i}_{j}"]
        return row["loss"] + float(beta @ penalty @ beta) / 2, gradient, curvature + penalty

    beta = np.zeros(len(columns))
    loss, gradient, curvature = moments(beta)
    for step in range(1, max_steps + 1):
        move = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
        while True:
            tried = moments(beta - move)
            if tried[0] <= loss + 1e-12 * (1 + abs(loss)) or np.abs(move).max() < tol:
                break
            move = move / 2  # too far: the loss must not rise
        beta = beta - move
        loss, gradient, curvature = tried
        if np.abs(move).max() < tol:
            break
    else:
        raise ValueError(f"the logistic fit did not settle in {max_steps} steps")
    weights = np.zeros(size)
    weights[used] = [beta[i + 1] / deviation[j] for i, j in enumerate(used)]
    return Logistic(tuple(names), tuple(map(float, weights)), float(beta[0] - weights @ np.array(mean)), step, loss)


def odds_table(model: Logistic, spark: SparkSession) -> DataFrame:
    """Effect of one unit of every feature on the odds."""
    rows = [(f, c, math.exp(c), (math.exp(c) - 1) * 100) for f, c in zip(model.features, model.coefficients)]
    return spark.createDataFrame(rows, "feature string, coef double, odds_ratio double, percent_change double")
