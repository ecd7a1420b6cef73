import math
import random

import numpy as np
import pandas as pd
import pytest

from sparkmine.operators import montecarlo as MC
from sparkmine.operators import timeseries as TS

N = 200


@pytest.fixture(scope="module")
def values():
    rng = random.Random(6)
    return [10 + 0.05 * t + 3 * math.sin(2 * math.pi * t / 30) + rng.gauss(0, 1) for t in range(N)]


@pytest.fixture(scope="module")
def series(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "t int, y double").repartition(5)


@pytest.mark.parametrize("block", [TS.BLOCK, 17, 64])
def test_autocorrelation(series, values, block):
    y = np.array(values) - np.mean(values)
    expected = [1.0] + [float((y[k:] * y[:-k]).sum() / (y * y).sum()) for k in range(1, 41)]
    rows = TS.autocorrelation(series, 40, block=block).orderBy("lag").collect()
    assert [r["acf"] for r in rows] == pytest.approx(expected)
    assert rows[0]["band"] == 0 and rows[1]["band"] == pytest.approx(1.959964 / math.sqrt(N), rel=1e-5)
    assert rows[2]["band"] == pytest.approx(1.959964 * math.sqrt((1 + 2 * expected[1] ** 2) / N), rel=1e-5)


@pytest.mark.parametrize("block", [TS.BLOCK, 16])
def test_lag_correlations_equal_shifted_frames(series, values, block):
    shifted = pd.concat([pd.Series(values).shift(i) for i in range(8)], axis=1).corr().to_numpy()
    rows = TS.lag_correlations(series, 8, block=block).collect()
    assert len(rows) == 64
    for r in rows:
        assert r["corr"] == pytest.approx(shifted[r["i"], r["j"]])


@pytest.mark.parametrize("period,block", [(30, TS.BLOCK), (30, 20), (7, 25)])
def test_decomposition(series, values, period, block):
    rows = TS.seasonal_decompose(series, period, block=block).orderBy("t").collect()
    y, half = np.array(values), period // 2
    weights = np.ones(2 * half + 1)
    if period % 2 == 0:
        weights[[0, -1]] = 0.5
    inner = np.convolve(y, weights / period, mode="valid")
    trend = np.array([r["trend"] for r in rows])
    assert len(rows) == N and trend[half:-half] == pytest.approx(inner)
    slope, intercept = np.polyfit(np.arange(half, half + period), inner[:period], 1)
    assert trend[:half] == pytest.approx(intercept + slope * np.arange(half))
    seasonal = np.array([r["seasonal"] for r in rows])
    assert seasonal[:period].sum() == pytest.approx(0, abs=1e-9) and seasonal[:-period] == pytest.approx(seasonal[period:])
    assert trend + seasonal + np.array([r["resid"] for r in rows]) == pytest.approx(y)


def test_spectrum_equals_fft(series, values):
    expected = 2 / N * np.abs(np.fft.fft(values))[1:40]
    rows = TS.amplitude_spectrum(series, 39).orderBy("k").collect()
    assert [r["amplitude"] for r in rows] == pytest.approx(expected.tolist())


def test_daily_counts_fill_gaps(spark):
    days = ["2024-01-01", "2024-01-01", "2024-01-04", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("to_date(d) AS ts")
    rows = TS.daily_counts(df, "ts").orderBy("t").collect()
    assert [(r["t"], str(r["day"]), r["y"]) for r in rows] == [
        (0, "2024-01-01", 2.0), (1, "2024-01-02", 0.0), (2, "2024-01-03", 0.0), (3, "2024-01-04", 1.0),
    ]


def test_pi(spark):
    random_ = MC.pi_random(spark, 200_000, 8, seed=1).first()
    assert random_["points"] == 200_000 and random_["pi"] == pytest.approx(math.pi, abs=0.02)

    def point(i):
        x = ((i * 1103515245 + 12345) % 2**31) / 2**31 * 2 - 1
        y = ((i * 22695477 + 1) % 2**32) / 2**32 * 2 - 1
        return x * x + y * y < 1

    repeatable = MC.pi_from_keys(spark.range(50), "id", 10).first()
    assert (repeatable["points"], repeatable["inside"]) == (500, sum(point(i) for i in range(500)))


def test_the_bench_total_has_no_simulators():
    import bench

    assert not [name for name in [*bench.FILE_JOBS, *bench.HEADLINE] if name.startswith("pi_")]
