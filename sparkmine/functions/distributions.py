"""Tails of Student's t, F and chi-square distributions as column expressions.

Arguments are SQL expressions over the row. The incomplete beta and gamma functions are continued fractions folded inside the
row, so p-values and quantiles need no driver round trip. The number of terms grows with the square root of the degrees
of freedom, as convergence asks for.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = "1e-300D"  # keeps a zero denominator away without changing any other
_names = itertools.count()


def _bound(values: dict[str, str], body: str) -> str:
    """``body`` with every named value computed once, however often the body names it."""
    held = f"v{next(_names)}"
    for i, name in enumerate(values):
        body = body.replace(f"{{{name}}}", f"{held}[{i}]")
    inner = ", ".join(f"CAST({v} AS DOUBLE)" for v in values.values())
    return f"transform(array(array({inner})), {held} -> {body})[0]"


def _folded(terms: str, start: list[str], step: list[str], result: str) -> str:
    """Fold the state ``{s0}, {s1}, ...`` over the terms ``{j}``."""
    state, j = f"s{next(_names)}", f"j{next(_names)}"

    def named(text: str) -> str:
        for i in range(len(start)):
            text = text.replace(f"{{s{i}}}", f"{state}[{i}]")
        return text.replace("{j}", j)

    return f"aggregate({terms}, array({', '.join(start)}), ({state}, {j}) -> array({', '.join(map(named, step))}), {state} -> {named(result)})"


def _log_gamma(x: str) -> str:
    """Stirling's series ten steps further up."""
    product = " * ".join(["{x}", *[f"({{x}} + {k})" for k in range(1, 10)]])
    z = "({x} + 10)"
    w = f"(1 / ({z} * {z}))"
    series = f"(1 / 12D - {w} * (1 / 360D - {w} * (1 / 1260D - {w} * (1 / 1680D - {w} / 1188D)))) / {z}"
    return _bound({"x": x}, f"(({z} - 0.5D) * ln({z}) - {z} + {0.5 * math.log(2 * math.pi)!r}D + {series} - ln({product}))")


def _terms(size: str) -> str:
    """Enough terms for arguments of this size, two per round of the fractions."""
    return f"sequence(2, CAST(least(2 * ceil(60 + 3 * sqrt({size})), 20000000) AS INT))"


def _beta_fraction(a: str, b: str, x: str) -> str:
    """Lentz's form of the continued fraction of the incomplete beta function, one coefficient per term."""
    first = f"1 / (1 - ({a} + {b}) * {x} / ({a} + 1) + {TINY})"
    m = "floor({j} / 2)"
    even, odd = f"{m} * ({b} - {m})", f"-({a} + {m}) * ({a} + {b} + {m})"
    k = f"(CASE WHEN {{j}} % 2 = 0 THEN {even} ELSE {odd} END * {x} / (({a} + {{j}} - 1) * ({a} + {{j}})))"
    up, down = f"(1 + {k} / {{s0}} + {TINY})", f"(1 + {k} * {{s1}} + {TINY})"
    return _folded(_terms(f"greatest({a}, {b})"), ["1.0D", first, first], [up, f"1 / {down}", f"{{s2}} * {up} / {down}"], "{s2}")


def _beta(a: str, b: str, x: str, rest: str) -> str:
    """Regularised incomplete beta function at ``x``, with ``rest = 1 - x`` given so that it keeps its digits."""
    front = f"exp({_log_gamma('{a} + {b}')} - {_log_gamma('{a}')} - {_log_gamma('{b}')} + {{a}} * ln({{x}}) + {{b}} * ln({{rest}}))"
    low = f"{front} * {_beta_fraction('{a}', '{b}', '{x}')} / {{a}}"
    high = f"1 - {front} * {_beta_fraction('{b}', '{a}', '{rest}')} / {{b}}"
    inside = f"CASE WHEN {{x}} < ({{a}} + 1) / ({{a}} + {{b}} + 2) THEN {low} ELSE {high} END"
    return _bound({"a": a, "b": b, "x": x, "rest": rest}, f"CASE WHEN {{x}} <= 0 THEN 0.0D WHEN {{rest}} <= 0 THEN 1.0D ELSE {inside} END")


def _f_tail(f: str, d1: str, d2: str) -> str:
    body = _beta("{d2} / 2", "{d1} / 2", "{d2} / ({d2} + {d1} * {f})", "{d1} * {f} / ({d2} + {d1} * {f})")
    return _bound({"f": f, "d1": d1, "d2": d2}, body)


def log_gamma(x: str) -> Column:
    """Logarithm of the gamma function for positive ``x``."""
    return F.expr(_log_gamma(x))


def f_probability(f: str, d1: str, d2: str) -> Column:
    """Upper tail of the F distribution."""
    return F.expr(_f_tail(f, d1, d2))


def t_probability(t: str, dof: str) -> Column:
    """Two-sided p-value of a t statistic."""
    return F.expr(_f_tail(f"power({t}, 2)", "1", dof))


def chi2_probability(x: str, dof: str) -> Column:
    """Upper tail of the chi-square distribution: a continued fraction far out, one minus a series near zero."""
    front = f"exp({{a}} * ln({{h}}) - {{h}} - {_log_gamma('{a}')})"
    terms = _terms("greatest({a}, {h})")
    grown = "{s0} * {h} / ({a} + {j} - 1)"
    series = _folded(terms, ["1 / {a}", "1 / {a}"], [grown, f"{{s1}} + {grown}"], "{s1}")
    k, opening = "(-({j} - 1) * ({j} - 1 - {a}))", "({h} + 1 - {a})"
    up, down = f"({{s0}} + 2 + {k} / {{s1}} + {TINY})", f"({k} * {{s2}} + {{s0}} + 2 + {TINY})"
    start = [opening, "1e300D", f"1 / ({opening} + {TINY})", f"1 / ({opening} + {TINY})"]
    fraction = _folded(terms, start, ["{s0} + 2", up, f"1 / {down}", f"{{s3}} * {up} / {down}"], "{s3}")
    body = f"CASE WHEN {{h}} <= 0 THEN 1.0D WHEN {{h}} < {{a}} + 1 THEN 1 - {front} * {series} ELSE {front} * {fraction} END"
    return F.expr(_bound({"h": f"({x}) / 2", "a": f"({dof}) / 2"}, body))


def t_critical(confidence: float, dof: str) -> Column:
    """Quantile that leaves ``1 - confidence`` in both tails, by bisection of ``t / (1 + t)``."""
    middle = "({s0} + {s1} / 2)"
    tail = _f_tail(f"power({middle} / (1 - {middle}), 2)", "1", "{dof}")
    step = [f"{{s0}} + CASE WHEN {tail} > {1 - confidence!r}D THEN {{s1}} / 2 ELSE 0.0D END", "{s1} / 2"]
    share = _folded("sequence(1, 60)", ["0.0D", "0.999999999D"], step, "{s0}")
    return F.expr(_bound({"dof": dof}, _bound({"share": share}, "{share} / (1 - {share})")))
