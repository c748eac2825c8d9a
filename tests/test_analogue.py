"""Nearest past windows against all windows laid out whole."""

import numpy as np
import pytest

from tests.helpers import regular
from tidegrid.operators import analogue, baseline
from tidegrid.operators.evaluate import backtest_holdout
from tidegrid.spec import Spec

LOOKBACK, STEPS = 8, 3
SPEC = Spec(period=4, chunk=50, horizon=STEPS)


def plain(y, nearest):
    """(distance, origin, continuation) of the nearest windows, and the forecast."""
    y = np.asarray(y, float)

    def shaped(w):
        s = w.std()
        return (w - w.mean()) / s if s > 1e-9 else np.zeros(len(w))

    q = y[-LOOKBACK:]
    found = []
    for o in range(LOOKBACK, len(y) - STEPS + 1):
        w = y[o - LOOKBACK : o]
        s = w.std() if w.std() > 1e-9 else 1.0
        found.append((float(np.sum((shaped(w) - shaped(q)) ** 2)), o, (y[o : o + STEPS] - w.mean()) / s))
    found = sorted(found, key=lambda f: (round(f[0], 9), f[1]))[:nearest]
    d = np.array([f[0] for f in found])
    width = d.mean() - d.min()
    weight = np.exp(-(d - d.min()) / width) if width > 0 else np.ones(len(d))
    ahead = q.mean() + q.std() * (weight[:, None] * np.array([f[2] for f in found])).sum(0) / weight.sum()
    return found, ahead


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(4)
    t = np.arange(400)
    return {
        "wave": 10 + 5 * np.sin(2 * np.pi * t / 11) + rng.normal(0, 0.3, 400),
        "noise": rng.normal(0, 1, 150),
        "least": rng.normal(0, 1, LOOKBACK + STEPS),
        "flat": np.r_[np.full(40, 2.0), rng.normal(0, 1, 30)],
        "short": rng.normal(0, 1, LOOKBACK + STEPS - 1),
    }


def table_of(spark, series):
    out = None
    for k, y in series.items():
        one = regular(spark, y, series_id=k)
        out = one if out is None else out.unionByName(one)
    return out


def test_all_nearest_windows_are_found(spark, series):
    """Recall against all windows is 1, over stretches of 50 rows."""
    rows = analogue.nearest_windows(table_of(spark, series).repartition(3), SPEC, STEPS, LOOKBACK, 6).collect()
    for k, y in series.items():
        mine = sorted((r.rank, r.origin, r.distance, r.continuation) for r in rows if r.series_id == k)
        if len(y) < LOOKBACK + STEPS:
            assert not mine
            continue
        want = plain(y, 6)[0]
        assert [m[1] for m in mine] == [w[1] for w in want]
        assert [m[2] for m in mine] == pytest.approx([w[0] for w in want], abs=1e-6)
        for m, w in zip(mine, want):
            assert m[3] == pytest.approx(w[2], abs=1e-6)


def test_forecast_is_the_weighted_continuation(spark, series):
    got = analogue.analogue_forecast(table_of(spark, series), SPEC, lookback=LOOKBACK, nearest=6).collect()
    for k, y in series.items():
        mine = sorted((r.h, r.yhat, r.model_used) for r in got if r.series_id == k)
        assert [m[0] for m in mine] == [1, 2, 3]
        if len(y) >= LOOKBACK + STEPS:
            assert [m[1] for m in mine] == pytest.approx(plain(y, 6)[1].tolist(), rel=1e-6, abs=1e-6)
            assert mine[0][2] == "analogue"
        else:
            assert mine[0][2] != "analogue"


def test_follows_a_pattern_that_no_season_has(spark, series):
    """A cycle of eleven steps in a table whose season is four."""
    spec = Spec(period=4, chunk=64, horizon=8, validation_days=2, k_days=3)
    models = {
        "analogue": lambda df, s, steps: analogue.analogue_forecast(df, s, steps, lookback=22),
        "average": lambda df, s, steps: baseline.seasonal_naive(df, s, steps, k=3),
    }
    scores = {r.model: r.mse for r in backtest_holdout(table_of(spark, {"wave": series["wave"]}), models, spec).collect()}
    assert scores["analogue"] < 0.1 * scores["average"]


def test_constant_newest_window_and_missing_values(spark):
    table = regular(spark, [5.0, 6.0] * 20 + [3.0] * LOOKBACK)
    got = analogue.analogue_forecast(table, SPEC, lookback=LOOKBACK).collect()
    assert [r.yhat for r in got] == [3.0] * STEPS
    holes = table.selectExpr("series_id", "ts", "CASE WHEN pos = 10 THEN NULL ELSE value END AS value", "pos", "n")
    rows = analogue.nearest_windows(holes, SPEC, STEPS, LOOKBACK, 100).collect()
    assert rows and all(not r.origin - LOOKBACK <= 10 < r.origin + STEPS for r in rows)
