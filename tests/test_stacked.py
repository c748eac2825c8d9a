"""Stacked blocks against samples laid out whole."""

import numpy as np
import pytest

from tests.helpers import regular
from tidegrid.operators import regression, stacked
from tidegrid.operators.evaluate import backtest_holdout
from tidegrid.spec import Spec

LOOKBACK, STEPS = 12, 5
SPEC = Spec(period=6, chunk=70, horizon=STEPS)


def wave(n, seed, period=6):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 40 + 8 * np.sin(2 * np.pi * t / period) + 3 * np.cos(2 * np.pi * t / 17) + rng.normal(0, 1, n)


def scale(y):
    return (y - y.min()) / (y.max() - y.min())


def samples(y, share):
    z = scale(y)
    rows = np.array([np.r_[1.0, z[o - LOOKBACK : o + STEPS]] for o in range(LOOKBACK, len(z) - STEPS + 1)])
    cut = int(np.floor(share * len(rows)))
    return rows[:cut], rows[cut:]


def plain_stack(x, y, widths, penalty):
    """Blocks on whole sample arrays: every block sees residual arrays, not sums. Returns what each forecasts."""
    seen, left, out = x.copy(), y.copy(), []
    ridge = penalty * np.sum(x[:, 1:] ** 2) / (x.shape[1] - 1)
    for width in widths:
        damp = np.sqrt(ridge) * np.eye(x.shape[1])[1:]
        full = np.linalg.lstsq(np.r_[seen, damp], np.r_[left, np.zeros((len(damp), y.shape[1]))], rcond=None)[0]
        _, _, directions = np.linalg.svd(seen @ full, full_matrices=False)
        few = seen @ full @ directions[:width].T
        forecast = few @ np.linalg.lstsq(few, left, rcond=None)[0]
        recall = few @ np.linalg.lstsq(few, seen, rcond=None)[0]
        recall[:, 0] = 0.0
        out.append(forecast)
        seen, left = seen - recall, left - forecast
    return out


@pytest.fixture(scope="module")
def series():
    return {"a": wave(400, 1), "b": wave(150, 2) * 3, "c": wave(LOOKBACK + STEPS, 3), "d": wave(8, 4)}


def table_of(spark, series):
    out = None
    for k, y in series.items():
        one = regular(spark, y, series_id=k)
        out = one if out is None else out.unionByName(one)
    return out


def test_sums_are_those_of_all_samples(spark, series):
    table = table_of(spark, {k: scale(y) for k, y in series.items()}).withColumnRenamed("value", "z").repartition(3)
    got = stacked._matrices(stacked.window_sums(table, LOOKBACK, STEPS, SPEC, 0.8), 1 + LOOKBACK + STEPS)
    parts = [samples(y, 0.8) for y in series.values() if len(y) >= LOOKBACK + STEPS]
    for part in (0, 1):
        x = np.concatenate([p[part] for p in parts])
        assert got[part] == pytest.approx(x.T @ x, rel=1e-9, abs=1e-9)


def test_three_blocks_equal_blocks_on_arrays(series):
    train = np.concatenate([samples(series[k], 0.8)[0] for k in "ab"])
    x, y = train[:, : 1 + LOOKBACK], train[:, 1 + LOOKBACK :]
    for penalty in (1e-3, 1e-1):
        forecasts, backcasts = stacked.stack_blocks(train.T @ train, 1 + LOOKBACK, (1, 2, 2), penalty)
        want = plain_stack(x, y, (1, 2, 2), penalty)
        for f, w in zip(forecasts, want):
            assert x @ f == pytest.approx(w, rel=1e-4, abs=1e-6)
        assert len(backcasts) == 3


def test_validation_chooses_what_a_search_of_all_fits_chooses(series):
    widths, penalties = (1, 1, 2, 2), (1e-6, 1e-2, 1e-1, 1.0)
    train, valid = (np.concatenate([samples(series[k], 0.8)[p] for k in "ab"]) for p in (0, 1))
    stack = stacked.fit_stack(np.stack([train.T @ train, valid.T @ valid]), 1 + LOOKBACK, widths, penalties)
    errors = {}
    for penalty in penalties:
        forecasts, _ = stacked.stack_blocks(train.T @ train, 1 + LOOKBACK, widths, penalty)
        last = np.inf
        for count in range(1, len(widths) + 1):
            yhat = valid[:, : 1 + LOOKBACK] @ sum(forecasts[:count])
            error = np.mean((valid[:, 1 + LOOKBACK :] - yhat) ** 2)
            if error >= last:
                break
            errors[penalty, count] = last = error
    assert (stack.penalty, stack.blocks) == min(errors, key=errors.get)
    assert stack.valid_error == pytest.approx(min(errors.values()), rel=1e-6)


def test_forecast_is_the_stack_on_the_newest_lookback(spark, series):
    got = stacked.stacked_horizon(table_of(spark, series), SPEC, lookback=LOOKBACK, widths=(2, 2)).collect()
    train, valid = (np.concatenate([samples(y, 0.8)[p] for y in series.values() if len(y) >= LOOKBACK + STEPS]) for p in (0, 1))
    stack = stacked.fit_stack(np.stack([train.T @ train, valid.T @ valid]), 1 + LOOKBACK, (2, 2))
    for k, y in series.items():
        mine = sorted((r.h, r.yhat, r.model_used) for r in got if r.series_id == k)
        assert [m[0] for m in mine] == list(range(1, STEPS + 1))
        if len(y) >= LOOKBACK:
            want = np.r_[1.0, scale(y)[-LOOKBACK:]] @ stack.weights * (y.max() - y.min()) + y.min()
            assert [m[1] for m in mine] == pytest.approx(want.tolist(), rel=1e-6) and mine[0][2] == "stacked_horizon"
        else:
            assert mine[0][2] != "stacked_horizon"


def test_held_out_error_is_not_above_one_regression_per_step(spark):
    spec = Spec(period=6, chunk=256, horizon=6, validation_days=1, k_days=2)
    table = table_of(spark, {k: wave(500, 10 + i) for i, k in enumerate("abc")})
    models = {
        "direct": lambda df, s, steps: regression.direct_horizon(df, s, steps),
        "stacked": lambda df, s, steps: stacked.stacked_horizon(df, s, steps, lookback=42),
    }
    scores = {(r.series_id, r.model): r.mse for r in backtest_holdout(table, models, spec).collect()}
    mean = {m: np.mean([v for (_, k), v in scores.items() if k in (m, f"{m}_horizon")]) for m in models}
    assert mean["stacked"] <= mean["direct"] * 1.02


def test_no_sample_at_all(spark):
    got = stacked.stacked_horizon(regular(spark, [1.0, 2.0, 3.0]), SPEC, lookback=LOOKBACK).collect()
    assert len(got) == STEPS and {r.model for r in got} == {"stacked_horizon"} and "stacked_horizon" not in {r.model_used for r in got}
