"""Basis functions and the unit-root test against least squares on whole arrays."""

import math

import numpy as np
import pytest

from tests.helpers import regular
from tidegrid.operators import basis, unitroot
from tidegrid.spec import Spec

SPEC = Spec(period=6, chunk=50)


def design(t, n, degree, daily, weekly):
    u = t / (n - 1)
    cols = [u**k for k in range(degree + 1)]
    for count, length in ((daily, 6), (weekly, 42)):
        for k in range(1, count + 1):
            cols += [np.sin(2 * np.pi * k * t / length), np.cos(2 * np.pi * k * t / length)]
    return np.array(cols).T


def test_basis_forecast_matches_least_squares(spark):
    rng = np.random.default_rng(2)
    n, steps = 210, 9
    t = np.arange(n)
    y = 3 + 0.02 * t + 4 * np.sin(2 * np.pi * t / 6 + 0.3) + 2 * np.cos(2 * np.pi * t / 42) + rng.normal(0, 0.5, n)
    got = basis.basis_forecast(regular(spark, y), SPEC, steps, degree=1, daily=2).orderBy("h").collect()
    x = design(t, n, 1, 2, 1)
    b, rss, _, _ = np.linalg.lstsq(x, y, rcond=None)
    sigma2 = rss[0] / (n - x.shape[1])
    ahead = design(np.arange(n, n + steps), n, 1, 2, 1)
    assert [r.yhat for r in got] == pytest.approx(ahead @ b, rel=1e-8)
    assert [r.trend for r in got] == pytest.approx(ahead[:, :2] @ b[:2], rel=1e-8)
    assert [r.trend + r.season for r in got] == pytest.approx([r.yhat for r in got])
    spreading = np.einsum("hi,ij,hj->h", ahead, np.linalg.inv(x.T @ x), ahead)
    half = 1.959963984540054 * np.sqrt(sigma2 * (1 + spreading))
    assert [r.upper - r.yhat for r in got] == pytest.approx(half, rel=1e-7)
    assert [r.yhat - r.lower for r in got] == pytest.approx(half, rel=1e-7)
    # and it finds what the series was made of
    assert ahead @ b == pytest.approx(3 + 0.02 * np.arange(n, n + steps) + 4 * np.sin(2 * np.pi * np.arange(n, n + steps) / 6 + 0.3) + 2 * np.cos(2 * np.pi * np.arange(n, n + steps) / 42), abs=0.6)


def test_basis_parts_reach_the_ends(spark):
    n = 130
    t = np.arange(n)
    y = 5 + 0.1 * t + np.sin(2 * np.pi * t / 6)
    rows = basis.basis_decompose(regular(spark, y), SPEC, degree=1).orderBy("ts").collect()
    assert len(rows) == n
    assert [r.trend for r in rows] == pytest.approx(5 + 0.1 * t, abs=1e-6)
    assert [r.remainder for r in rows] == pytest.approx([0.0] * n, abs=1e-6)


def test_basis_of_short_and_constant_series(spark):
    table = regular(spark, [7.0] * 60).unionByName(regular(spark, [1.0, 2.0, 3.0], series_id="b"))
    got = basis.basis_forecast(table, SPEC, 3).collect()
    assert [r.yhat for r in got if r.series_id == "a"] == pytest.approx([7.0] * 3, rel=1e-6)
    assert {r.model_used != "basis" and r.trend is None for r in got if r.series_id == "b"} == {True}


def plain_test(y, most=None):
    """The test as textbooks have it: AIC over lag counts on equal rows, then all rows of the best."""
    y = np.asarray(y, float)
    n = len(y)
    most = unitroot.most_lags(n) if most is None else min(most, unitroot.most_lags(n))
    d = np.diff(y)

    def fit(lags, first):
        rows = np.arange(first, len(d))
        x = np.array([np.ones(len(rows)), y[rows], *[d[rows - k] for k in range(1, lags + 1)]]).T
        b = np.linalg.lstsq(x, d[rows], rcond=None)[0]
        rss = np.sum((d[rows] - x @ b) ** 2)
        error = np.sqrt(rss / (len(rows) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
        return len(rows) * math.log(rss / len(rows)) + 2 * x.shape[1], b[1] / error, len(rows)

    best = min(range(most + 1), key=lambda k: fit(k, most)[0])
    return best, fit(best, best)[2], fit(best, best)[1]


@pytest.mark.parametrize("most", [None, 3, 0])
def test_lagged_test_matches_least_squares(spark, most):
    rng = np.random.default_rng(8)
    e = rng.normal(0, 1, 400)
    walk, pulled, echo = np.cumsum(e), np.zeros(400), np.zeros(400)
    for t in range(4, 400):
        pulled[t] = 0.5 * pulled[t - 1] + e[t]
        echo[t] = echo[t - 1] + 0.6 * (echo[t - 3] - echo[t - 4]) + e[t]
    series = {"walk": 50 + walk, "pulled": 20 + pulled, "echo": echo, "short": pulled[:23], "tiny": [1.0, 3.0, 2.0, 5.0, 4.0, 6.0, 3.0]}
    table = None
    for k, y in series.items():
        one = regular(spark, y, series_id=k)
        table = one if table is None else table.unionByName(one)
    got = {r.series_id: r for r in unitroot.stationarity_lagged(table.repartition(3), SPEC, most).collect()}
    for k, y in series.items():
        lags, used, stat = plain_test(y, most)
        assert (got[k].lags, got[k].used, got[k].n) == (lags, used, len(y))
        assert got[k].stat == pytest.approx(stat, rel=1e-6) and got[k].p == pytest.approx(unitroot.p_value(stat), abs=1e-9)
        assert got[k].stationary == (got[k].p <= 0.05)
    if most is None:
        assert not got["walk"].stationary and got["pulled"].stationary


def test_constant_and_single_rows_have_no_statistic(spark):
    table = regular(spark, [4.0] * 40).unionByName(regular(spark, [1.0], series_id="b")).unionByName(regular(spark, [1.0, 2.0], series_id="c"))
    for r in unitroot.stationarity_lagged(table, SPEC).collect():
        assert r.stat is None and r.p is None and r.stationary is None


def test_p_values_at_published_points():
    """5 % and 1 % points of the large-sample distribution, and a smooth turning point."""
    assert unitroot.p_value(-2.86154) == pytest.approx(0.05, abs=0.001)
    assert unitroot.p_value(-3.43035) == pytest.approx(0.01, abs=0.001)
    assert unitroot.p_value(-1.61) == pytest.approx(unitroot.p_value(-1.6099), abs=0.005)
    assert (unitroot.p_value(-30), unitroot.p_value(5)) == (0.0, 1.0)
