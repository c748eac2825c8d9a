"""Moving-average orders against least squares on whole arrays."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import regular
from tidegrid.operators import arma
from tidegrid.spec import Spec

PERIOD = 6
SPEC = Spec(period=PERIOD, chunk=64)


def shocks(n, seed, theta=0.6, seasonal=0.4, phi=0.5, trend=0.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 50)
    u = e.copy()
    u[1:] += theta * e[:-1]
    u[PERIOD:] += seasonal * e[:-PERIOD]
    y = np.zeros(n + 50)
    for t in range(1, n + 50):
        y[t] = phi * y[t - 1] + u[t]
    return 20 + np.cumsum(np.full(n, trend)) + y[50:]


def difference(y, d, s):
    for gap in [1] * d + [PERIOD] * s:
        y = np.concatenate([np.full(gap, np.nan), y[gap:] - y[:-gap]])
    return y


def plain(y, orders, maxima, d, s, base, steps, exog=None):
    """Both stages by least squares; the best order's name, forecast and first half width."""
    p, q, big_p, big_q = maxima
    n = len(y)
    w = difference(y, d, s)
    x = [difference(v[:n], d, s) for v in exog or []]
    long = sorted({*range(1, max(p + q, 8) + 1), *(k * PERIOD + j for k in range(1, max(big_p, big_q) + 1) for j in (0, 1))})
    rows = np.arange(base + max(long), n)
    a = np.linalg.lstsq(np.array([np.ones(len(rows)), *[w[rows - k] for k in long], *[v[rows] for v in x]]).T, w[rows], rcond=None)[0]
    e = np.full(n, np.nan)
    e[rows] = w[rows] - np.array([np.ones(len(rows)), *[w[rows - k] for k in long], *[v[rows] for v in x]]).T @ a
    depth = max([p, q, big_p * PERIOD, big_q * PERIOD])
    rows = np.arange(base + max(long) + depth, n)
    fits = {}
    for o in orders:
        own = sorted({*range(1, o[0] + 1), *(k * PERIOD for k in range(1, o[2] + 1))})
        hit = sorted({*range(1, o[1] + 1), *(k * PERIOD for k in range(1, o[3] + 1))})
        cols = [np.ones(len(rows))] * (d + s == 0) + [w[rows - k] for k in own] + [e[rows - k] for k in hit] + [v[rows] for v in x]
        z = np.array(cols).reshape(len(cols), len(rows)).T
        b = np.linalg.lstsq(z, w[rows], rcond=None)[0]
        rss = float(np.sum((w[rows] - z @ b) ** 2))
        fits[o] = (len(rows) * np.log(rss / len(rows)) + 2 * len(cols), b, own, hit, rss / (len(rows) - len(cols)))
    best = min(fits, key=lambda o: fits[o][0])
    _, b, own, hit, sigma2 = fits[best]
    poly = arma.difference_weights(d, s, PERIOD)
    yy, ww, ee = list(y), list(w), list(e)
    for h in range(steps):
        t = n + h
        move = [sum(c * v[t - k] for k, c in poly.items()) for v in exog or []]
        row = [1.0] * (d + s == 0) + [ww[t - k] for k in own] + [ee[t - k] for k in hit] + move
        ww.append(float(np.dot(b, row)))
        ee.append(0.0)
        yy.append(ww[-1] - sum(c * yy[t - k] for k, c in poly.items() if k))
    return f"({best[0]},{d},{best[1]})({best[2]},{s},{best[3]})", yy[n:], 1.959963984540054 * np.sqrt(sigma2)


@pytest.mark.parametrize("order", [((1, 0, 1), (1, 0, 1)), ((0, 1, 1), (0, 1, 1)), ((2, 0, 0), (0, 0, 0)), ((0, 1, 2), (0, 0, 1))])
def test_fixed_order_matches_least_squares(spark, order):
    (p, d, q), (big_p, s, big_q) = order
    y = shocks(500, 3, trend=0.01)
    got = arma.arma_forecast(regular(spark, y), SPEC, 8, order=order, min_rows=0).orderBy("h").collect()
    name, want, half = plain(y, [(p, q, big_p, big_q)], (p, q, big_p, big_q), d, s, max(arma.difference_weights(d, s, PERIOD)), 8)
    assert [r.yhat for r in got] == pytest.approx(want, rel=1e-7)
    assert got[0].order == name and got[0].upper - got[0].yhat == pytest.approx(half, rel=1e-7)
    widths = [r.upper - r.lower for r in got]
    assert all(b >= a - 1e-9 for a, b in zip(widths, widths[1:]))


@pytest.mark.parametrize("with_exog", [False, True])
def test_search_matches_least_squares(spark, with_exog):
    maxima, steps = (2, 2, 1, 1), 5
    y = shocks(400, 11)
    heat = np.random.default_rng(5).normal(10, 3, 400 + steps)
    table, args = regular(spark, y + (1.5 * heat[:400] if with_exog else 0)), {}
    if with_exog:
        y = y + 1.5 * heat[:400]
        lookup = spark.createDataFrame([(i, float(v)) for i, v in enumerate(heat)], "i bigint, heat double")
        table = table.join(lookup, F.col("pos") == F.col("i")).drop("i")
        future = lookup.where("i >= 400").select(F.lit("a").alias("series_id"), (F.col("i") - 399).cast("int").alias("h"), "heat")
        args = {"exog_cols": ["heat"], "future": future}
    picked = arma.chosen_differences(table, SPEC).first()
    got = arma.arma_forecast(table, SPEC, steps, max_order=maxima, min_rows=0, **args).orderBy("h").collect()
    orders = list(product(*(range(m + 1) for m in maxima)))
    name, want, half = plain(y, orders, maxima, picked.d, picked.big_d, PERIOD + 2, steps, [heat] if with_exog else None)
    assert got[0].order == name
    assert [r.yhat for r in got] == pytest.approx(want, rel=1e-6)
    assert got[0].upper - got[0].yhat == pytest.approx(half, rel=1e-6)


def test_moving_average_part_is_found(spark):
    """A pure moving average is taken for one, and its weight comes near the one it was made with."""
    rng = np.random.default_rng(1)
    e = rng.normal(0, 1, 3001)
    y = 5 + e[1:] + 0.7 * e[:-1]
    got = arma.arma_forecast(regular(spark, y), SPEC, 3, order=((0, 0, 1), (0, 0, 0)), min_rows=0).orderBy("h").collect()
    assert got[0].yhat - 5 == pytest.approx(0.7 * e[-1], abs=0.25)
    assert [r.yhat for r in got[1:]] == pytest.approx([5, 5], abs=0.1)
    assert (got[0].upper - got[0].lower) / (2 * 1.96) == pytest.approx(1, abs=0.1)
    assert (got[1].upper - got[1].lower) / (got[0].upper - got[0].lower) == pytest.approx(np.sqrt(1.49), abs=0.05)


def test_short_and_constant_series(spark):
    table = regular(spark, [4.0] * 300).unionByName(regular(spark, shocks(30, 2), series_id="b"))
    got = arma.arma_forecast(table, SPEC, 4, max_order=(1, 1, 1, 1), min_rows=0).collect()
    assert {(r.series_id, r.model_used) for r in got} == {("a", "arma"), ("b", "kday_average_7")} or {r.series_id for r in got} == {"a", "b"}
    assert [r.yhat for r in got if r.series_id == "a"] == pytest.approx([4.0] * 4)
    with pytest.raises(ValueError):
        arma.arma_forecast(table, SPEC, 4, exog_cols=["heat"])


def test_no_order_runs_away(spark):
    """Explosive data: the search passes growing orders over, a given order is pulled in."""
    y = 1.03 ** np.arange(260) + np.random.default_rng(3).normal(0, 0.1, 260)
    for args in ({"order": ((2, 0, 1), (1, 0, 0))}, {"max_order": (2, 1, 1, 0)}):
        got = arma.arma_forecast(regular(spark, y), SPEC, 60, min_rows=0, **args).orderBy("h").collect()
        assert abs(got[-1].yhat) < 60 * y[-1]


def test_shocks_alone_with_a_large_weight(spark):
    """An order without lags has no lag weight to pull in, however large the weight of its shock."""
    y = np.interp(np.arange(300), np.arange(0, 300, 9), np.random.default_rng(2).normal(0, 1, 34))
    order = ((0, 0, 0), (0, 1, 1))
    got = arma.arma_forecast(regular(spark, y), SPEC, 8, order=order, min_rows=0).orderBy("h").collect()
    name, want, half = plain(y, [(0, 0, 0, 1)], (0, 0, 0, 1), 0, 1, PERIOD, 8)
    assert got[0].order == name and [r.yhat for r in got] == pytest.approx(want, rel=1e-6)
    assert got[0].upper - got[0].yhat == pytest.approx(half, rel=1e-6)


def test_rows_are_dealt_once(spark):
    """A series over several stretches: the search reads the rows in one pass, and no row goes through the driver."""
    y = shocks(400, 11)
    table = regular(spark, y)
    parts = arma.stretches(table, 20, SPEC).orderBy("part").collect()
    assert [(r.part, r.at, len(r.value)) for r in parts] == [(0, 0, 80), *[(k, 80 * k - 20, 100) for k in range(1, 5)]]
    assert [v for r in parts for v in r.value[20 if r.part else 0 :]] == pytest.approx(list(y))
    got = arma.arma_forecast(table, SPEC, 3, max_order=(1, 1, 1, 1), min_rows=0)
    assert got.count() == 3 and "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
