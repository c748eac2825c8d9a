"""Forecasters without SQL, against numpy on small data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import column, regular, series
from tidegrid.operators import baseline, features, regression, windows
from tidegrid.operators.select import training_part
from tidegrid.spec import Spec

RNG = np.random.default_rng(7)


def wave(n, period=12, noise=1.0):
    t = np.arange(n)
    return 50 + 10 * np.sin(2 * np.pi * t / period) + np.cumsum(RNG.normal(0, noise, n)) * 0.1 + RNG.normal(0, noise, n)


def test_ar1_matches_numpy(spark):
    y = wave(300)
    spec = Spec(period=12)
    b, a = np.polyfit(y[:-1], y[1:], 1)
    want, last = [], y[-1]
    for _ in range(5):
        last = a + b * last
        want.append(last)
    assert column(regression.ar1(regular(spark, y), spec, 5), "yhat", "h") == pytest.approx(want, rel=1e-9)


def test_ar1_of_constant_series(spark):
    assert column(regression.ar1(regular(spark, [4.0] * 30), Spec(period=12), 3), "yhat", "h") == [4.0] * 3


def _ols_candidates(y, level, period, max_p, exog=None):
    """All candidate fits on the common sample by plain least squares."""
    lags = sorted({*range(1, max_p + 3), *range(period, period + max_p + 3)})
    c = y - level
    rows = np.arange(lags[-1], len(c))
    lag = lambda k: c[rows - k]
    ones = np.ones(len(rows))
    out = {}

    def fit(name, target, cols):
        x = np.array(cols).reshape(len(cols), len(rows)).T
        beta = np.linalg.lstsq(x, target, rcond=None)[0]
        rss = float(np.sum((target - x @ beta) ** 2))
        m = len(rows)
        out[name] = (m * np.log(rss / m) + 2 * x.shape[1], rss, beta)

    def differenced(v, d, seasonal):
        """The series after its differences, aligned so that index i stays time i."""
        for gap in [1] * d + [period] * seasonal:
            v = np.concatenate([np.full(gap, np.nan), v[gap:] - v[:-gap]])
        return v

    for d in range(3):
        for big_p, big_d in ((0, 0), (1, 0), (0, 1)):
            w = differenced(c, d, big_d)
            ex = [differenced(np.asarray(e, float), d, big_d)[rows] for e in exog or []]
            for p in range(max_p + 1):
                cols = [ones] * (d == 0) + [w[rows - i] for i in range(1, p + 1)] + [w[rows - period]] * big_p + ex
                fit(f"({p},{d},0)({big_p},{big_d},0)", w[rows], cols)
    return out


@pytest.mark.parametrize("with_exog", [False, True])
def test_ar_search_matches_least_squares(spark, with_exog):
    period, n, max_p, steps = 12, 240, 2, 6
    spec = Spec(period=period)
    heat = RNG.normal(20, 5, n + steps)
    y = wave(n, period) + (2.0 * heat[:n] if with_exog else 0)
    table = regular(spark, y)
    args = {}
    if with_exog:
        lookup = spark.createDataFrame([(i, float(v)) for i, v in enumerate(heat)], "i bigint, heat double")
        table = table.join(lookup, F.col("pos") == F.col("i")).drop("i")
        future = lookup.where(F.col("i") >= n).select(F.lit("a").alias("series_id"), (F.col("i") - n + 1).cast("int").alias("h"), "heat")
        args = {"exog_cols": ["heat"], "future": future}
    out = regression.ar_forecast(table, spec, steps, max_p=max_p, min_rows=0, **args).orderBy("h").collect()
    level = y[period + max_p + 2 :].mean()
    fits = _ols_candidates(y, level, period, max_p, [heat[:n]] if with_exog else None)
    best = min(fits, key=lambda k: fits[k][0])
    assert out[0]["order"] == best
    # Roll the best model out by hand.
    beta, c = fits[best][2], list(y - level)
    p, d, seasonal, seasonal_difference = int(best[1]), int(best[3]), int(best[8]), int(best[10])

    def change(v, i):
        """Differenced value at time i of a plain sequence."""
        poly = {0: 1.0}
        for gap in [1] * d + [period] * seasonal_difference:
            grown = dict(poly)
            for k, f in poly.items():
                grown[k + gap] = grown.get(k + gap, 0.0) - f
            poly = grown
        return sum(f * v[i - k] for k, f in poly.items())

    for h in range(steps):
        i = len(c)
        x = [1.0] * (d == 0) + [change(c, i - k) for k in range(1, p + 1)] + [change(c, i - period)] * seasonal
        x += [change(heat, i)] if with_exog else []
        # the differenced value with 0 for the unknown one leaves what the past contributes
        c.append(0.0)
        c[i] = float(np.dot(beta, x)) - change(c, i)
    want = [v + level for v in c[n:]]
    assert [r["yhat"] for r in out] == pytest.approx(want, rel=1e-6)
    sigma = np.sqrt(fits[best][1] / (n - period - max_p - 2 - len(beta)))
    first = out[0]
    assert first["upper"] - first["yhat"] == pytest.approx(1.959963984540054 * sigma, rel=1e-6)
    widths = [r["upper"] - r["lower"] for r in out]
    assert all(b >= a - 1e-9 for a, b in zip(widths, widths[1:]))


@pytest.mark.parametrize("exog_future", ["freeze", "calendar", "asof"])
def test_lag_recursive_matches_numpy(spark, exog_future):
    spec = Spec(period=4, chunk=16)
    # 200 half hours from a Monday end on a Friday; 230 reach into the weekend.
    lags, steps = (1, 4, 28), 60
    ys = {"a": wave(350, 4), "b": wave(230, 4) * 2}
    raw = series(spark, [(s, 30 * i, float(v)) for s, y in ys.items() for i, v in enumerate(y)])
    hot = [(s, 60 * i, float(np.sin(i / 5))) for s, y in ys.items() for i in range((len(y) + 1) // 2)]
    weather = series(spark, hot).withColumnRenamed("value", "temperature_2m")
    table = features._regular(raw, spec)
    out = regression.lag_recursive(table, weather, spec, steps, exog_future=exog_future, share=0.8)
    feats = features.feature_matrix(table, weather, spec).orderBy("series_id", "pos").toPandas()
    xs, targets, scaled = [], [], {}
    for s, g in feats.groupby("series_id"):
        z = g[["demand", "is_weekend", "temperature_2m"]].to_numpy(float)
        lo, hi = z.min(0), z.max(0)
        span = np.where(hi > lo, hi - lo, 1.0)
        z = (z - lo) / span
        scaled[s] = (z, lo, span, g["ts"].max())
        n, first = len(z), 28
        for i in range(first, first + int(np.floor(0.8 * (n - first)))):
            xs.append([1.0, *[z[i - k, 0] for k in lags], z[i - 1, 1], z[i - 1, 2]])
            targets.append(z[i, 0])
    beta = np.linalg.lstsq(np.array(xs), np.array(targets), rcond=None)[0]
    for s, (z, lo, span, end) in scaled.items():
        behind = len(ys[s]) - len(z)
        path, n = list(z[:, 0]), len(z)
        for h in range(1, steps + behind + 1):
            flag, heat = z[-1, 1], z[-1, 2]
            if h > 1 and exog_future != "freeze":
                day = (end + pd.Timedelta(minutes=30 * (h - 1))).weekday()
                flag = (float(day >= 5) - lo[1]) / span[1]
            if h > 1 and exog_future == "asof" and h - 1 <= steps + 4:
                # A week is 336 half hours; shorter series fall back to their mean.
                back = n - 1 + (h - 1) - 336
                heat = z[back, 2] if back >= 0 else z[:, 2].mean()
            path.append(float(np.dot(beta, [1.0, *[path[-k] for k in lags], flag, heat])))
        want = [v * span[0] + lo[0] for v in path[-steps:]]
        got = column(out.where(F.col("series_id") == s), "yhat", "h")
        assert got == pytest.approx(want, rel=1e-6)


@pytest.mark.parametrize("chunk", [64, 4096])
def test_direct_horizon_matches_numpy(spark, chunk):
    spec = Spec(period=4, chunk=chunk)
    steps, lookback = 6, 28
    ys = {"a": wave(150, 4), "b": 3 * wave(130, 4)}
    table = regular(spark, ys["a"], series_id="a").unionByName(regular(spark, ys["b"], series_id="b"))
    out = regression.direct_horizon(table, spec, steps, share=0.8)
    z = {s: (y - y.min()) / (y.max() - y.min()) for s, y in ys.items()}

    def x(v, i, h):
        return [1.0, v[i], v[i + h - 4 * -(-h // 4)], v[i + h - 28 * -(-h // 28)]]

    for h in (1, 4, 6):
        rows, targets = [], []
        for v in z.values():
            count = len(v) - lookback - steps + 1
            for i in range(lookback - 1, lookback - 1 + int(np.floor(0.8 * count))):
                rows.append(x(v, i, h))
                targets.append(v[i + h])
        beta = np.linalg.lstsq(np.array(rows), np.array(targets), rcond=None)[0]
        for s, v in z.items():
            want = float(np.dot(beta, x(v, len(v) - 1, h))) * (ys[s].max() - ys[s].min()) + ys[s].min()
            got = out.where((F.col("series_id") == s) & (F.col("h") == h)).first()["yhat"]
            assert got == pytest.approx(want, rel=1e-7)


@pytest.mark.parametrize("period, chunk", [(4, 16), (4, 4096), (7, 4096)])
def test_decomposition(spark, period, chunk):
    y = wave(90, period)
    out = regression.seasonal_decompose(regular(spark, y), Spec(period=period, chunk=chunk)).orderBy("ts").toPandas()
    half = period // 2
    weights = np.ones(period + 1 - period % 2) / period
    if period % 2 == 0:
        weights[[0, -1]] /= 2
    trend = np.full(90, np.nan)
    trend[half : 90 - half] = np.convolve(y, weights, "valid")
    rest = y - trend
    means = np.array([np.nanmean(rest[s::period]) for s in range(period)])
    season = np.tile(means - means.mean(), 90 // period + 1)[:90]
    np.testing.assert_allclose(out["trend"], trend, rtol=1e-9)
    np.testing.assert_allclose(out["season"], season, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("walk", [False, True])
def test_stationarity(spark, walk):
    noise = RNG.normal(0, 1, 400)
    y = np.cumsum(noise) if walk else noise
    row = regression.stationarity(regular(spark, y), Spec(chunk=32)).first()
    d, level = np.diff(y), y[:-1]
    x = np.column_stack([np.ones(399), level])
    beta, *_ = np.linalg.lstsq(x, d, rcond=None)
    rss = np.sum((d - x @ beta) ** 2)
    se = np.sqrt(rss / 397 / np.sum((level - level.mean()) ** 2))
    assert row["stat"] == pytest.approx(beta[1] / se, rel=1e-9)
    if not walk:
        assert row["stationary"]


def test_fallback_depends_on_history_only(spark):
    spec = Spec(period=4)
    long, short = regular(spark, wave(60, 4), series_id="long"), regular(spark, range(8), series_id="short")
    out = baseline.with_fallback(long.unionByName(short), spec, 40, regression.ar1, 5)
    used = {r["series_id"]: r["model_used"] for r in out.collect()}
    assert used == {"long": "ar1", "short": "kday_average_7"}


@pytest.mark.parametrize("chunk", [8, 4096])
def test_lookback_windows_and_cap(spark, chunk):
    table = regular(spark, range(50))
    spec = Spec(chunk=chunk)
    rows = windows.lookback_windows(table, ["value"], "value", 5, spec).orderBy("pos").collect()
    assert len(rows) == 45
    for r in rows:
        assert [w["value"] for w in r["window"]] == [float(v) for v in range(r["pos"] - 5, r["pos"])]
        assert r["target"] == r["pos"]
    capped = windows.lookback_windows(table, ["value"], "value", 5, spec, cap=10).orderBy("pos").collect()
    assert [r["pos"] for r in capped] == list(range(40, 50)) and all(len(r["window"]) == 5 for r in capped)
    targets = windows.horizon_targets(table, "value", 4, spec).orderBy("pos").collect()
    # Every complete window counts, also the last one.
    assert len(targets) == 47 and list(targets[-1]["targets"]) == [46.0, 47.0, 48.0, 49.0]


def test_holdout_never_sees_validation(spark):
    spec = Spec(period=2, validation_days=2)
    table = regular(spark, [1, 2, 1, 2, 1, 2, 99, 99, 99, 99])
    out = baseline.seasonal_naive(training_part(table, spec), spec, 4)
    assert column(out, "yhat", "h") == [1.0, 2.0, 1.0, 2.0]


def _two(spark, short, long=900):
    """A long and a short series of one table."""
    return regular(spark, wave(long), series_id="long").unionByName(regular(spark, range(short), series_id="short"))


def _forecasters(spec):
    from tidegrid.plans.comparison import all_models

    return all_models(spec)


@pytest.mark.parametrize("short", [1, 5, 17, 60])
def test_every_model_answers_for_every_series(spark, short):
    spec = Spec(period=12, horizon=8)
    table = _two(spark, short)
    for name, make in _forecasters(spec).items():
        rows = make(table, spec, 8).collect()
        per = {s: {r["h"] for r in rows if r["series_id"] == s and r["yhat"] is not None} for s in ("long", "short")}
        assert per == {"long": set(range(1, 9)), "short": set(range(1, 9))}, name
        used = {r["model_used"] for r in rows if r["series_id"] == "short"}
        if name in ("ar_p", "lag_recursive", "direct_horizon"):
            assert used == {"persistence" if short < 12 else "kday_average_7"}, name


def test_models_refuse_tables_cut_to_their_tail(spark):
    spec = Spec(period=12, horizon=4)
    cut = regular(spark, wave(900)).where("pos >= 100")
    for name in ("ar1", "ar_p", "lag_recursive", "direct_horizon"):
        with pytest.raises(Exception, match="needs whole series"):
            _forecasters(spec)[name](cut, spec, 4).collect()


def test_all_history_is_fitted(spark):
    spec = Spec(period=4)
    y = np.concatenate([wave(400, 4) * 3, wave(200, 4)])
    b, a = np.polyfit(y[:-1], y[1:], 1)
    table = regular(spark, y)
    assert column(regression.ar1(table, spec, 1), "yhat", "h") == pytest.approx([a + b * y[-1]])
    b, a = np.polyfit(y[-40:-1], y[-39:], 1)
    assert column(regression.ar1(table, spec, 1, train_seasons=10), "yhat", "h") == pytest.approx([a + b * y[-1]])


def test_series_without_weather_are_forecast(spark):
    from tidegrid.plans.comparison import all_models

    spec = Spec(period=4, horizon=6)
    ys = {"a": wave(620, 4), "b": wave(640, 4)}
    raw = series(spark, [(s, 30 * i, float(v)) for s, y in ys.items() for i, v in enumerate(y)])
    weather = series(spark, [("a", 60 * i, float(np.sin(i / 5))) for i in range(310)]).withColumnRenamed("value", "temperature_2m")
    table = features._regular(raw, spec)
    for name, make in all_models(spec, weather).items():
        rows = make(table, spec, 6).collect()
        assert {(r["series_id"], r["h"]) for r in rows if r["yhat"] is not None} == {(s, h) for s in ys for h in range(1, 7)}, name


def test_direct_horizon_with_covariates(spark):
    """A covariate that moves the target is found, also when it is scaled on the first part only."""
    n, steps = 400, 5
    spec = Spec(period=4)
    heat = RNG.normal(0, 1, n + steps)
    y = 20 + 5 * heat[:n] + RNG.normal(0, 0.01, n)
    lookup = spark.createDataFrame([(i, float(v)) for i, v in enumerate(heat)], "i bigint, heat double")
    table = regular(spark, y).join(lookup, F.col("pos") == F.col("i")).drop("i")
    future = lookup.where(F.col("i") >= n).select(F.lit("a").alias("series_id"), (F.col("i") - n + 1).cast("int").alias("h"), "heat")
    for share in (None, 0.5):
        out = regression.direct_horizon(table, spec, steps, exog_cols=["heat"], future=future, scaler_share=share)
        assert column(out, "yhat", "h") == pytest.approx(20 + 5 * heat[n:], abs=0.1)
