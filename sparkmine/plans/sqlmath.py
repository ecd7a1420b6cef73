"""SQL text for numerical steps that the learning queries are checked with."""

from __future__ import annotations


def solved(source: str, n: int) -> str:
    """``source`` with the solution ``x0..`` of its symmetric system added.

    The system is ``m{i}_{j}`` (j >= i) and ``v{i}``; one nested SELECT per eliminated unknown.
    """
    sql = source
    for k in range(n - 1):
        new = [f"m{i}_{j} - m{k}_{i} / m{k}_{k} * m{k}_{j} AS m{i}_{j}" for i in range(k + 1, n) for j in range(i, n)]
        new += [f"v{i} - m{k}_{i} / m{k}_{k} * v{k} AS v{i}" for i in range(k + 1, n)]
        sql = f"SELECT * REPLACE ({', '.join(new)}) FROM ({sql})"
    for i in reversed(range(n)):
        rest = "".join(f" - m{i}_{j} * x{j}" for j in range(i + 1, n))
        sql = f"SELECT *, (v{i}{rest}) / m{i}_{i} AS x{i} FROM ({sql})"
    return sql


def newton_logistic(rows: str, features: list[str], label: str, reg: float, steps: int = 12) -> str:
    """One row ``b, w0..``: intercept and weights of the ridge-penalised logistic fit of the relation ``rows``.

    Twelve plain Newton steps from zero, the 0/1 label in ``label``; the penalty is on weights times sample deviations.
    """
    n = len(features) + 1
    stats = ", ".join(f"avg({f}) AS a{j}, stddev_samp({f}) AS d{j}" for j, f in enumerate(features, 1))
    scaled = ", ".join(f"({f} - a{j}) / d{j} AS z{j}" for j, f in enumerate(features, 1))
    eta = " + ".join(f"s{j} * z{j}" for j in range(n))
    matrix = ", ".join(
        f"avg(p * (1 - p) * z{i} * z{j}) + {reg if i == j and i else 0.0}::DOUBLE AS m{i}_{j}" for i in range(n) for j in range(i, n)
    )
    vector = ", ".join(f"avg((p - y) * z{i}) + {reg if i else 0.0}::DOUBLE * any_value(s{i}) AS v{i}" for i in range(n))
    carried = ", ".join(f"any_value(s{i}) AS s{i}" for i in range(n))
    system = f"""SELECT any_value(step) AS step, {carried}, {matrix}, {vector}
        FROM (SELECT *, 1 / (1 + exp(-({eta}))) AS p FROM newton, scaled) WHERE step < {steps} HAVING count(*) > 0"""
    weights = ", ".join(f"s{j} / d{j} AS w{j - 1}" for j in range(1, n))
    shift = "".join(f" - s{j} / d{j} * a{j}" for j in range(1, n))
    return f"""(
    WITH RECURSIVE stats AS (SELECT {stats} FROM {rows}),
    scaled AS MATERIALIZED (SELECT {label}::DOUBLE AS y, 1.0::DOUBLE AS z0, {scaled} FROM {rows}, stats),
    newton AS (
        SELECT 0 AS step, {", ".join(f"0.0::DOUBLE AS s{i}" for i in range(n))}
        UNION ALL SELECT step + 1, {", ".join(f"s{i} - x{i}" for i in range(n))} FROM ({solved(system, n)})
    )
    SELECT s0{shift} AS b, {weights} FROM newton, stats WHERE step = {steps})"""


def t_tail(t: str, dof: str, panels: int = 4000) -> str:
    """Two-sided t probability by Simpson's rule over the angle ``atan(t / sqrt(dof))``."""
    angle = f"atan(abs({t}) / sqrt({dof}))"
    weights = f"CASE WHEN i = 0 OR i = {panels} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = f"list_sum(list_transform(range({panels + 1}), lambda i: {weights} * cos({angle} * i / {panels}) ** ({dof} - 1))) * {angle} / {3 * panels}"
    return f"(1 - 2 * exp(lgamma(({dof} + 1) / 2) - lgamma({dof} / 2)) / sqrt(pi()) * {area})"
