import math

import pytest

from sparkmine.functions import distributions as D
from sparkmine.operators import linear as L


def _row(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_log_gamma(spark):
    for x in (0.1, 0.5, 1.0, 2.5, 7.0, 150.5, 7500.0):
        assert _row(spark, v=D.log_gamma(f"{x}D"))["v"] == pytest.approx(math.lgamma(x), rel=1e-13, abs=1e-13)


@pytest.mark.parametrize("dof", [1, 2, 5, 30, 15000])
def test_t_tails(spark, dof):
    for t in (0.0, 0.3, -1.0, 2.5, 8.0):
        assert _row(spark, v=D.t_probability(f"{t}D", f"{dof}"))["v"] == pytest.approx(L.t_probability(t, dof), rel=1e-9, abs=1e-14)
    assert _row(spark, v=D.t_critical(0.95, f"{dof}"))["v"] == pytest.approx(L.t_critical(0.95, dof), rel=1e-8)


def test_closed_forms(spark):
    # t with one degree is Cauchy, with two algebraic; chi-square with two degrees is exponential, with one a normal tail.
    got = _row(spark, a=D.t_probability("1.7D", "1"), b=D.t_probability("1.7D", "2"), c=D.chi2_probability("3.1D", "2"), d=D.chi2_probability("3.1D", "1"), e=D.chi2_probability("0.2D", "4"), f=D.chi2_probability("40D", "6"), g=D.f_probability("3D", "2", "10"), h=D.f_probability("2.89D", "1", "2"))
    assert got["a"] == pytest.approx(1 - 2 / math.pi * math.atan(1.7))
    assert got["b"] == pytest.approx(1 - 1.7 / math.sqrt(2 + 1.7**2))
    assert got["c"] == pytest.approx(math.exp(-1.55)) and got["d"] == pytest.approx(math.erfc(math.sqrt(1.55)))
    assert got["e"] == pytest.approx(math.exp(-0.1) * 1.1) and got["f"] == pytest.approx(math.exp(-20) * (1 + 20 + 200))
    assert got["g"] == pytest.approx((1 + 2 * 3.0 / 10) ** -5) and got["h"] == pytest.approx(got["b"])
    assert _row(spark, v=D.chi2_probability("0D", "3"))["v"] == 1.0
