"""Trees grown from distributed histograms against trees grown on whole arrays."""

import numpy as np
import pytest

from tests.helpers import regular, stamp
from tidegrid.operators import boosted, regression
from tidegrid.operators.evaluate import backtest_holdout
from tidegrid.operators.scaling import minmax_fit, minmax_transform
from tidegrid.spec import Spec

LOOKBACK = 6
SPEC = Spec(period=6, chunk=40, horizon=5)


def jumpy(n, seed):
    """A value that depends on the last ones by thresholds."""
    rng = np.random.default_rng(seed)
    y = [0.5] * 3
    for t in range(3, n):
        y.append((0.8 if y[-1] < 0.4 else 0.2) + 0.3 * (y[-3] > 0.6) + rng.normal(0, 0.03))
    return np.array(y) * 10


def table_of(spark, series):
    out = None
    for k, y in series.items():
        one = regular(spark, y, series_id=k)
        out = one if out is None else out.unionByName(one)
    return out


def plain_samples(y, share):
    """Bins and units of all samples of a series, laid out whole."""
    z = (y - y.min()) / (y.max() - y.min())
    rows, units = [], []
    for t in range(LOOKBACK, len(z)):
        at = stamp(30 * t)
        place = (at.hour * 3600 + at.minute * 60) * boosted.BINS // 86400
        lags = [min(max(int(np.floor(z[t - k] * boosted.BINS)), 0), boosted.BINS - 1) for k in range(1, LOOKBACK + 1)]
        rows.append([*lags, place, (boosted.BINS - 1) * (at.weekday() >= 5)])
        units.append(int(np.floor(abs(z[t]) * boosted.UNITS + 0.5)))
    cut = int(np.floor(share * len(rows))) if share else len(rows)
    return np.array(rows[:cut]), units[:cut], np.array(rows[cut:]).reshape(-1, LOOKBACK + 2), units[cut:]


def plain_tree(x, g, depth, rate, penalty, least):
    """Splits (path, feature, bin) and the value of every row, one node at a time."""
    value = [0] * len(g)
    splits = []

    def grow(rows, path):
        total = sum(g[i] for i in rows)
        best = (0.0, None)
        if len(path) < depth:
            for f in range(x.shape[1]):
                for b in range(boosted.BINS - 1):
                    left = [i for i in rows if x[i, f] <= b]
                    n, s = len(left), sum(g[i] for i in left)
                    if n >= least and len(rows) - n >= least:
                        gain = float(s) ** 2 / (n + penalty) - float(total) ** 2 / (len(rows) + penalty)
                        gain += float(total - s) ** 2 / (len(rows) - n + penalty)
                        if gain > best[0]:
                            best = (gain, (f, b))
        if best[1] is None:
            for i in rows:
                value[i] = boosted.leaf_value(total, len(rows), rate, penalty)
            return
        f, b = best[1]
        splits.append((path, f, b))
        grow([i for i in rows if x[i, f] <= b], path + "l")
        grow([i for i in rows if x[i, f] > b], path + "r")

    grow(list(range(len(g))), "")
    return sorted(splits), value


def splits_of(tree):
    out = []

    def walk(i, path):
        if tree.feature[i] >= 0:
            out.append((path, tree.feature[i], tree.bin[i]))
            walk(2 * i + 1, path + "l")
            walk(2 * i + 2, path + "r")

    walk(0, "")
    return sorted(out)


@pytest.mark.parametrize("write_every", [1, 100])
def test_split_for_split_equal_to_a_plain_version(spark, monkeypatch, write_every):
    monkeypatch.setattr(boosted, "WRITE_EVERY", write_every)
    series = {"a": jumpy(150, 1), "b": jumpy(90, 2), "c": jumpy(LOOKBACK + 1, 3), "d": jumpy(4, 4)}
    table = table_of(spark, series).withColumnRenamed("value", "z0").withColumnRenamed("z0", "value").repartition(3)
    scaled = minmax_transform(table, minmax_fit(table, ["value"]), ["value"], SPEC.chunk).withColumnRenamed("value", "z")
    rows = boosted.stretches(scaled.where(f"n > {LOOKBACK}"), LOOKBACK, (), SPEC, 0.8)
    settings = {"depth": 2, "rate": 0.5, "penalty": 1.0, "least": 3}
    got = boosted.fit_boosted(rows, LOOKBACK, 0, trees=3, patience=99, **settings)
    parts = [plain_samples(y, 0.8) for y in series.values() if len(y) > LOOKBACK]
    x, valid = np.concatenate([p[0] for p in parts if len(p[0])]), np.concatenate([p[2] for p in parts])
    g = [v for p in parts for v in p[1]]
    left = [v for p in parts for v in p[3]]
    base = boosted.leaf_value(sum(g), len(g), 1.0, 0.0)
    assert got.base == base
    g = [v - base for v in g]
    errors = [np.mean([((v - base) / boosted.UNITS) ** 2 for v in left])]
    left = np.array(left) - base
    for k in range(3):
        splits, value = plain_tree(x, g, **settings)
        if k < len(got.trees):
            assert splits_of(got.trees[k]) == splits and len(splits) > 1
            left = left - np.array(got.trees[k].value)[got.trees[k].leaf(valid)]
            errors.append(np.mean((left / boosted.UNITS) ** 2))
        g = [a - b for a, b in zip(g, value)]
    assert got.errors == pytest.approx(errors[: len(got.errors)] if len(got.errors) <= len(errors) else got.errors, rel=1e-9)
    assert len(got.trees) == int(np.argmin(got.errors))


def test_stops_when_validation_does_not_gain(spark):
    noise = {"a": np.random.default_rng(4).normal(0, 1, 300)}
    table = table_of(spark, noise)
    scaled = minmax_transform(table, minmax_fit(table, ["value"]), ["value"], SPEC.chunk).withColumnRenamed("value", "z")
    got = boosted.fit_boosted(boosted.stretches(scaled, LOOKBACK, (), SPEC, 0.7), LOOKBACK, 0, trees=12, patience=2, least=2, rate=0.9)
    assert len(got.trees) == int(np.argmin(got.errors)) < 12 and len(got.errors) <= len(got.trees) + 3


def test_thresholds_are_learned_where_a_line_is_not_enough(spark):
    spec = Spec(period=6, chunk=500, horizon=2, validation_days=1, k_days=2)
    table = table_of(spark, {k: jumpy(700, 20 + i) for i, k in enumerate("abcd")})
    models = {
        "boosted": lambda df, s, steps: boosted.boosted_recursive(df, s, 2, lookback=LOOKBACK, trees=8),
        "line": lambda df, s, steps: regression.ar_forecast(df, s, 2, max_p=3, min_rows=0),
    }
    scores = backtest_holdout(table, models, spec).groupBy("model").avg("mse").collect()
    by = {r.model: r["avg(mse)"] for r in scores}
    assert by["boosted"] < 0.6 * by["line"]


def test_rollout_covariates_and_short_series(spark):
    series = {"a": jumpy(120, 5), "b": jumpy(60, 6), "c": jumpy(4, 7)}
    table = table_of(spark, series)
    heat = table.selectExpr("*", "cast(pos % 7 as double) as heat")
    got = boosted.boosted_recursive(heat, SPEC, lookback=LOOKBACK, exog_cols=["heat"], trees=2).collect()
    for k, y in series.items():
        mine = sorted((r.h, r.yhat, r.model_used) for r in got if r.series_id == k)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert (mine[0][2] == "boosted_recursive") == (len(y) >= LOOKBACK)
        if len(y) >= LOOKBACK:
            assert all(y.min() - 1 <= m[1] <= y.max() + 1 for m in mine)
    short = boosted.boosted_recursive(table_of(spark, {"c": jumpy(4, 7)}), SPEC, lookback=LOOKBACK).collect()
    assert len(short) == 5 and "boosted_recursive" not in {r.model_used for r in short}
