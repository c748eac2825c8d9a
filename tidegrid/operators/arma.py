"""Forecasts with moving-average orders, fitted in two stages from sums of products.

Moving-average terms are weights of past shocks, which nobody observes. The first stage is a long
autoregression of the differenced series; its residuals stand in for the shocks. The second stage
regresses the differenced series on its own lags and on lagged residuals, so every order is a
restriction of one regression and one matrix of sums per series serves the whole search.

A series is cut into stretches once, each with the rows before it that its lags reach. Tasks
multiply one stretch at a time, Spark adds up the sums by series, so no task holds a series.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import shift
from tidegrid.operators.baseline import seasonal_naive
from tidegrid.operators.chunked import dealt
from tidegrid.operators.regression import NORMAL_95, _candidates, _lags, _whole
from tidegrid.operators.select import gates, last_ts
from tidegrid.session import saved
from tidegrid.spec import Spec

#: Lags of the first stage next to the row: a moving average needs a long autoregression in its place.
NEAR = 8

Order = tuple[tuple[int, int, int], tuple[int, int, int]]


def difference_weights(d: int, seasonal: int, period: int) -> dict[int, float]:
    """Weights by lag of ``d`` plain and ``seasonal`` seasonal differences; lag 0 has weight 1."""
    poly = {0: 1.0}
    for gap in [1] * d + [period] * seasonal:
        grown = dict(poly)
        for k, c in poly.items():
            grown[k + gap] = grown.get(k + gap, 0.0) - c
        poly = grown
    return poly


def _long_lags(p: int, q: int, seasons: int, period: int) -> list[int]:
    """Lags of the first stage: at least NEAR next to the row, and two at every season."""
    return sorted({*range(1, max(p + q, NEAR) + 1), *(s * period + k for s in range(1, seasons + 1) for k in (0, 1))})


def spread(rows: DataFrame, per: DataFrame, spec: Spec) -> DataFrame:
    """Join one row per series to its rows, repeated for every stretch, so that no key is a whole series."""
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.lit(spec.chunk)))
    ends = rows.where(F.col("pos") == F.col("n") - 1).select("series_id", "n")
    stretched = per.join(ends, "series_id").withColumn("_part", F.explode(parts)).drop("n")
    return rows.withColumn("_part", F.floor(F.col("pos") / F.lit(spec.chunk))).join(stretched, ["series_id", "_part"]).drop("_part")


def _span(reach: int, spec: Spec) -> int:
    return max(spec.chunk, 4 * reach)


def stretches(rows: DataFrame, reach: int, spec: Spec, exog_cols: Sequence[str] = ()) -> DataFrame:
    """One row per stretch of a series: its values and those of the ``reach`` rows before it as arrays.

    ``at`` is the position of the first value. A stretch has a bounded number of rows, so every step
    after this one reads arrays of bounded length, and a long series is many of them.
    """
    span = _span(reach, spec)
    lowest = F.floor(F.col("pos") / F.lit(span))
    highest = F.floor(F.least(F.col("pos") + F.lit(reach), F.col("n") - 1) / F.lit(span))
    copies = rows.withColumn("part", F.explode(F.sequence(lowest, highest)))
    listed = copies.groupBy("series_id", "part", "n").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value", *exog_cols))).alias("r"), F.max(last_ts(spec)).alias("_last")
    )
    arrays = [_field("r", c).alias(name) for name, c in zip(["value", *[f"x{j}" for j in range(len(exog_cols))]], ["value", *exog_cols])]
    return listed.select("series_id", "part", "n", "_last", F.col("r")[0]["pos"].alias("at"), *arrays)


def with_series(parts: DataFrame, per: DataFrame, reach: int, spec: Spec) -> DataFrame:
    """Join one row per series, with its ``n``, to its stretches; no key is a whole series."""
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.lit(_span(reach, spec))))
    return parts.join(dealt(per.withColumn("part", F.explode(numbers)).drop("n")), ["series_id", "part"])


def chosen_differences(regular: DataFrame, spec: Spec, train_seasons: int | None = None) -> DataFrame:
    """Differences per series, ``d`` and ``big_d``: those of the best autoregression with up to two lags.

    Every candidate predicts the same values from the same columns on the same rows, so their AIC
    values compare across differences.
    """
    reach = max(_lags(2, spec.period)[0])
    return _differences(stretches(regular, reach, spec), reach, spec, train_seasons).drop("n")


def _differences(parts: DataFrame, reach: int, spec: Spec, train_seasons: int | None) -> DataFrame:
    period, span = spec.period, _span(reach, spec)
    lags, _ = _lags(2, period)
    depth = max(lags)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                y, pos = np.asarray(r.value, float), _positions(r)
                who = _own(pos, r, span) & (pos >= depth + _first(r.n, train_seasons, period))
                if who.any():
                    z = [np.ones(len(y)), *[_shifted(y, k) for k in lags], y]
                    out.append((r.series_id, r.n, int(who.sum()), _products(z, who)))
            yield pd.DataFrame(out, columns=["series_id", "n", "m", "gram"])

    key = parts.schema["series_id"].dataType.simpleString()
    grams = parts.select("series_id", "part", "n", "at", "value").mapInPandas(multiply, f"series_id {key}, n bigint, m bigint, gram array<double>")
    since = F.lit(0) if train_seasons is None else F.greatest(F.lit(0), F.col("n") - train_seasons * period)
    m = F.sum("m")
    sums = grams.groupBy("series_id", "n").agg(_whole(m, F.max(F.col("n") - depth - since), m, "arma").alias("m"), _added(len(lags) + 2))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = _candidates(2, period, 0)
        width = len(models[0][1]) + 1
        for pdf in batches:
            if not len(pdf):
                continue
            m = pdf["m"].to_numpy(float)
            full = _full(np.stack(pdf["gram"].to_numpy()), width)
            # centre by the mean: the systems are better conditioned, the residuals the same
            move = np.tile(np.eye(width), (len(pdf), 1, 1))
            move[:, 1:, 0] = -(full[:, 0, -1] / m)[:, None]
            full = move @ full @ np.transpose(move, (0, 2, 1))
            gram, gy, yy = full[:, :-1, :-1], full[:, :-1, -1], full[:, -1, -1]
            aic = []
            for _, base, free in models:
                b = np.tile(base, (len(pdf), 1))
                if free.shape[1]:
                    inner = np.linalg.pinv(free.T @ gram @ free, hermitian=True)
                    b = b + np.einsum("sij,sj->si", inner, (gy - gram @ base) @ free) @ free.T
                rss = yy - 2 * np.einsum("si,si->s", b, gy) + np.einsum("si,sij,sj->s", b, gram, b)
                rss = np.maximum(rss, 1e-12 * np.maximum(yy, 1e-12))
                aic.append(m * np.log(rss / m) + 2 * free.shape[1])
            orders = [re.findall(r"\d+", models[k][0]) for k in np.argmin(aic, axis=0)]
            yield pd.DataFrame({"series_id": pdf["series_id"], "n": pdf["n"], "d": [int(o[1]) for o in orders], "big_d": [int(o[4]) for o in orders]})

    return sums.mapInPandas(solve, f"series_id {key}, n bigint, d int, big_d int")


def _added(width: int) -> Column:
    """Sums of ``gram``, upper triangles of that width, over the stretches of a series."""
    return F.array(*[F.sum(F.col("gram")[i]) for i in range(width * (width + 1) // 2)]).alias("gram")


def _positions(r) -> np.ndarray:
    return r.at + np.arange(len(r.value))


def _own(pos: np.ndarray, r, span: int) -> np.ndarray:
    """Rows of the stretch itself; those before them belong to others."""
    return pos >= r.part * span


def _first(n: int, seasons: int | None, period: int) -> int:
    """First position that counts when only the newest ``seasons`` are to be fitted."""
    return 0 if seasons is None else max(0, n - seasons * period)


def _shifted(v: np.ndarray, k: int) -> np.ndarray:
    """``v`` moved ``k`` rows on; NaN where there is no such row."""
    out = np.full(len(v), np.nan)
    out[k:] = v[: max(len(v) - k, 0)]
    return out


def _differenced(v: np.ndarray, poly: dict[int, float]) -> np.ndarray:
    return sum(c * _shifted(v, k) for k, c in sorted(poly.items()))


def _products(z: Sequence[np.ndarray], who: np.ndarray) -> np.ndarray:
    """Upper triangle of the sums of products over the rows ``who``; a missing value adds nothing."""
    x = np.array([v[who] for v in z])
    x[np.isnan(x)] = 0.0
    return (x @ x.T)[np.triu_indices(len(x))]


def _full(gram: np.ndarray, width: int) -> np.ndarray:
    upper = np.triu_indices(width)
    full = np.zeros((len(gram), width, width))
    full[:, upper[0], upper[1]] = gram
    return full + np.transpose(np.triu(full, 1), (0, 2, 1))


def _least_squares(full: np.ndarray) -> np.ndarray:
    """Coefficients from matrices of sums whose last row and column are the target's."""
    return np.einsum("sij,sj->si", np.linalg.pinv(full[:, :-1, :-1], hermitian=True), full[:, :-1, -1])


def long_autoregression(parts: DataFrame, lags: Sequence[int], n_x: int, base: int, reach: int, spec: Spec, train_seasons: int | None) -> DataFrame:
    """The first stage: coefficients ``a`` per series on a constant, the lags of the differenced series and the covariates."""
    period, span, width = spec.period, _span(reach, spec), 2 + len(lags) + n_x

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                pos, (w, *x) = _positions(r), _moved(r, n_x, period)
                who = _own(pos, r, span) & (pos >= _first(r.n, train_seasons, period) + base + max(lags, default=0))
                if who.any():
                    out.append((r.series_id, r.n, r.d, r.big_d, _products([np.ones(len(w)), *[_shifted(w, k) for k in lags], *x, w], who)))
            yield pd.DataFrame(out, columns=["series_id", "n", "d", "big_d", "gram"])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                a = _least_squares(_full(np.stack(pdf["gram"].to_numpy()), width))
                yield pd.DataFrame({**{c: pdf[c] for c in ("series_id", "n", "d", "big_d")}, "a": list(a)})

    named = f"series_id {parts.schema['series_id'].dataType.simpleString()}, n bigint, d int, big_d int"
    grams = parts.mapInPandas(multiply, f"{named}, gram array<double>")
    return grams.groupBy("series_id", "n", "d", "big_d").agg(_added(width)).mapInPandas(solve, f"{named}, a array<double>")


def _moved(r, n_x: int, period: int) -> list[np.ndarray]:
    """The series and the covariates of a stretch, differenced."""
    poly = difference_weights(r.d, r.big_d, period)
    return [_differenced(np.asarray(v, float), poly) for v in (r.value, *[getattr(r, f"x{j}") for j in range(n_x)])]


def shock_sums(
    parts: DataFrame, lags: Sequence[int], own: Sequence[int], shocks: Sequence[int], n_x: int, base: int, keep: int, reach: int, spec: Spec,
    train_seasons: int | None,
) -> DataFrame:
    """The second stage per stretch: ``m`` rows, their sums of products, and in the last stretch the newest ``keep`` rows."""
    period, span = spec.period, _span(reach, spec)
    ahead_of, depth = max(lags, default=0), max([*own, *shocks, 0])
    columns = ["series_id", "d", "big_d", "_last", "m", "gram", "past_value", "past_w", "past_e", "past_x"]

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            # a name that begins with an underscore is no field of a named tuple
            for r in pdf.rename(columns={"_last": "last"}).itertuples():
                pos, (w, *x) = _positions(r), _moved(r, n_x, period)
                long = [np.ones(len(w)), *[_shifted(w, k) for k in lags], *x]
                e = w - sum(c * v for c, v in zip(r.a, long))
                known = pos >= base + ahead_of
                w, e = np.where(known, w, np.nan), np.where(known, e, np.nan)
                who = _own(pos, r, span) & (pos >= _first(r.n, train_seasons, period) + base + ahead_of + depth)
                z = [np.ones(len(w)), *[_shifted(w, k) for k in own], *[_shifted(e, k) for k in shocks], *x, w]
                sums = (int(who.sum()), _products(z, who)) if who.any() else (0, None)
                past = [None] * 4
                if r.part == (r.n - 1) // span:
                    newest = known & (pos >= r.n - keep)
                    levels = np.array([np.asarray(getattr(r, f"x{j}"), float)[newest] for j in range(n_x)])
                    past = [np.asarray(r.value, float)[newest], w[newest], e[newest], levels.T.reshape(-1)]
                out.append((r.series_id, r.d, r.big_d, r.last, *sums, *past))
            yield pd.DataFrame(out, columns=columns)

    listed = ", ".join(f"{c} array<double>" for c in columns[5:])
    return parts.mapInPandas(multiply, f"series_id {parts.schema['series_id'].dataType.simpleString()}, d int, big_d int, _last timestamp_ntz, m bigint, {listed}")


def arma_forecast(
    regular: DataFrame,
    spec: Spec,
    steps: int | None = None,
    *,
    order: Order | None = None,
    max_order: tuple[int, int, int, int] = (3, 3, 2, 2),
    exog_cols: Sequence[str] = (),
    future: DataFrame | None = None,
    model: str = "arma",
    min_rows: int | None = None,
    train_seasons: int | None = None,
) -> DataFrame:
    """Autoregression with moving-average and seasonal orders, a 95 % interval, and optional covariates.

    ``order`` is ((p, d, q), (P, D, Q)); without it differences are chosen per series by
    ``chosen_differences`` and the orders up to ``max_order`` (p, q, P, Q) by AIC on equal rows.
    Seasonal orders are lags at whole seasons, added to the near ones (no products). An order whose
    response to a shock still grows at the horizon is passed over for the next best; without any
    lag it never does. A given order is kept, its lag weights pulled in to the unit circle. Covariates are differenced like the series; ``regular`` holds them, ``future``
    their values for ``h = 1..steps``; a missing one counts as 0. Shocks after the last row are 0.

    All history counts, or the newest ``train_seasons``. Series with fewer than ``min_rows`` rows
    (by default the gate for autoregressions, and never fewer than both stages need) get the K-day
    average, named in ``model_used``. Adds ``lower``, ``upper`` and ``order``.
    """
    steps = spec.horizon if steps is None else steps
    if exog_cols and future is None:
        raise ValueError("exogenous columns need their future values")
    period = spec.period
    p, q, big_p, big_q = max_order if order is None else (order[0][0], order[0][2], order[1][0], order[1][2])
    if order is None:
        d_lags = sorted({k + s for k in range(3) for s in (0, period)})
    else:
        d_lags = sorted(difference_weights(order[0][1], order[1][1], period))
    long_lags = _long_lags(p, q, max(big_p, big_q), period)
    own = sorted({*range(1, p + 1), *(s * period for s in range(1, big_p + 1))})
    shocks = sorted({*range(1, q + 1), *(s * period for s in range(1, big_q + 1))})
    base, ahead_of = max(d_lags), max(long_lags, default=0)
    depth = max([*own, *shocks, 0])
    width = 2 + len(own) + len(shocks) + len(exog_cols)
    need = max(base + ahead_of + depth + 2 * width, gates(spec)["autoregression"] if min_rows is None else min_rows)
    keep = max(depth, base, 1)
    reach, n_x = base + ahead_of + keep, len(exog_cols)

    exog = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in exog_cols]
    table = regular.where(F.col("n") >= need).select("series_id", "ts", "pos", "n", "value", *exog)
    parts = saved(stretches(table, reach, spec, exog_cols))
    if order is None:
        picked = saved(_differences(parts, reach, spec, train_seasons))
        moved = with_series(parts, picked, reach, spec)
    else:
        moved = parts.withColumns({"d": F.lit(order[0][1]), "big_d": F.lit(order[1][1])})
    a = saved(long_autoregression(moved, long_lags, n_x, base, reach, spec, train_seasons))
    fits = saved(shock_sums(with_series(parts, a, reach, spec), long_lags, own, shocks, n_x, base, keep, reach, spec, train_seasons))
    sums = fits.where(F.col("gram").isNotNull()).groupBy("series_id", "d", "big_d", "_last").agg(F.sum("m").alias("m"), _added(width))
    recent = fits.where(F.col("past_w").isNotNull()).select("series_id", *[f"past_{c}" for c in ("value", "w", "e", "x")])
    state = sums.join(dealt(recent), "series_id")
    if exog_cols:
        coming = future.where(F.col("h") <= steps).groupBy("series_id").agg(
            F.sort_array(F.collect_list(F.struct("h", F.array(*exog_cols).cast("array<double>").alias("x")))).alias("_x")
        )
        flat = F.transform(F.flatten(_field("_x", "x")), lambda v: F.coalesce(v, F.lit(0.0)))
        state = state.join(dealt(coming.select("series_id", flat.alias("future"))), "series_id", "left")
        enough = F.coalesce(F.size("future"), F.lit(0)) == steps * len(exog_cols)
        lacks = F.raise_error(F.lit(f"{model} lacks future covariates"))
        state = state.withColumn("future", F.when(enough, F.col("future")).otherwise(lacks))
    else:
        state = state.withColumn("future", F.array().cast("array<double>"))

    orders = [(p, q, big_p, big_q)] if order else list(product(range(p + 1), range(q + 1), range(big_p + 1), range(big_q + 1)))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield _solved_orders(pdf, orders, own, shocks, n_x, period, steps, order is not None)

    key = regular.schema["series_id"].dataType.simpleString()
    schema = f"series_id {key}, _last timestamp_ntz, order string, yhat array<double>, lower array<double>, upper array<double>"
    solved = state.mapInPandas(solve, schema)
    ahead = F.arrays_zip(F.sequence(F.lit(1), F.lit(steps)).alias("h"), "yhat", "lower", "upper")
    rolled = solved.select("series_id", "_last", "order", F.inline(ahead))
    found = rolled.select(
        "series_id", F.lit(model).alias("model"), F.col("h").cast("int").alias("h"),
        shift("_last", F.col("h"), spec.step).alias("ts"), "yhat", F.lit(model).alias("model_used"), "lower", "upper", "order",
    )
    rest = seasonal_naive(regular.where(F.col("n") < need), spec, steps, k=spec.k_days).withColumn("model", F.lit(model))
    return found.unionByName(rest, allowMissingColumns=True)


def _field(rows: str, name: str) -> Column:
    return F.transform(rows, lambda r: r[name])


def _columns(order: tuple[int, int, int, int], own: Sequence[int], shocks: Sequence[int], n_x: int, period: int, constant: bool) -> list[int]:
    """Columns of the second stage that an order uses; the differenced series has no constant."""
    p, q, big_p, big_q = order
    lags = {*range(1, p + 1), *(s * period for s in range(1, big_p + 1))}
    hits = {*range(1, q + 1), *(s * period for s in range(1, big_q + 1))}
    out = [0] if constant else []
    out += [1 + i for i, k in enumerate(own) if k in lags]
    out += [1 + len(own) + i for i, k in enumerate(shocks) if k in hits]
    return out + [1 + len(own) + len(shocks) + j for j in range(n_x)]


def _solved_orders(pdf, orders, own, shocks, n_x, period, steps, fixed) -> pd.DataFrame:
    """The best order of every series of a batch and its forecast."""
    size, width = len(pdf), 2 + len(own) + len(shocks) + n_x
    full = _full(np.stack(pdf["gram"].to_numpy()), width)
    m = pdf["m"].to_numpy(float)
    plain = (pdf["d"] + pdf["big_d"]).to_numpy() == 0
    gram, gy, yy = full[:, :-1, :-1], full[:, :-1, -1], full[:, -1, -1]
    aic = np.full((size, len(orders)), np.inf)
    coef = np.zeros((size, len(orders), width - 1))
    rss = np.zeros((size, len(orders)))
    for k, order in enumerate(orders):
        for constant in (False, True):
            who = np.flatnonzero(plain == constant)
            cols = _columns(order, own, shocks, n_x, period, constant)
            if not len(who):
                continue
            b = np.zeros((len(who), width - 1))
            if cols:
                part = full[np.ix_(who, [*cols, width - 1], [*cols, width - 1])]
                b[:, cols] = _least_squares(part)
            left = yy[who] - 2 * np.einsum("si,si->s", b, gy[who]) + np.einsum("si,sij,sj->s", b, gram[who], b)
            left = np.maximum(left, 1e-12 * np.maximum(yy[who], 1e-12))
            enough = m[who] > len(cols) + 1
            aic[who, k] = np.where(enough, m[who] * np.log(left / m[who]) + 2 * len(cols), np.inf)
            coef[who, k], rss[who, k] = b, left / np.maximum(m[who] - len(cols), 1)
    lag_at, hit_at = 1, 1 + len(own)
    pick = np.argmin(aic, axis=1)
    everyone = np.arange(size)
    while True:
        c = coef[everyone, pick]
        psi = _impulse(c[:, lag_at:hit_at], c[:, hit_at : hit_at + len(shocks)], own, shocks, steps)
        wild = np.abs(psi[:, -period:]).max(1) > 1 + 1e-9 if steps > period else np.zeros(size, bool)
        wild &= ~np.isin(pick, [k for k, o in enumerate(orders) if o == (0, 0, 0, 0)])
        if fixed:
            c = _settled(c, wild, own, lag_at)
            psi = _impulse(c[:, lag_at:hit_at], c[:, hit_at : hit_at + len(shocks)], own, shocks, steps)
        if fixed or not wild.any():
            break
        aic[everyone[wild], pick[wild]] = np.inf
        least = next(k for k, o in enumerate(orders) if o == (0, 0, 0, 0))
        pick = np.where(wild, np.where(np.isinf(aic).all(1), least, np.argmin(aic, axis=1)), pick)
    past = {c: np.stack(pdf[f"past_{c}"].to_numpy()).astype(float) for c in ("value", "w", "e")}
    kept = past["w"].shape[1]
    w = np.concatenate([past["w"], np.zeros((size, steps))], axis=1)
    e = np.concatenate([past["e"], np.zeros((size, steps))], axis=1)
    y = np.concatenate([past["value"], np.zeros((size, steps))], axis=1)
    spread = np.concatenate([np.zeros((size, kept)), psi], axis=1)
    polys = [difference_weights(d, s, period) for d, s in zip(pdf["d"], pdf["big_d"])]
    gaps = sorted({k for poly in polys for k in poly if k})
    weight = np.array([[poly.get(k, 0.0) for k in gaps] for poly in polys]).reshape(size, len(gaps))
    if n_x:
        x = np.concatenate([np.stack(pdf[c].to_numpy()).astype(float).reshape(size, -1, n_x) for c in ("past_x", "future")], axis=1)
    for h in range(steps):
        t = kept + h
        w[:, t] = c[:, 0] + np.einsum("sl,sl->s", c[:, lag_at:hit_at], w[:, t - np.array(own, int)])
        w[:, t] += np.einsum("sl,sl->s", c[:, hit_at : hit_at + len(shocks)], e[:, t - np.array(shocks, int)])
        if n_x:
            moved = x[:, t] + np.einsum("sg,sgj->sj", weight, x[:, t - np.array(gaps, int)])
            w[:, t] += np.einsum("sj,sj->s", c[:, hit_at + len(shocks) :], moved)
        back = t - np.array(gaps, int)
        y[:, t] = w[:, t] - np.einsum("sg,sg->s", weight, y[:, back])
        spread[:, t] -= np.einsum("sg,sg->s", weight, spread[:, back])
    half = NORMAL_95 * np.sqrt(rss[everyone, pick][:, None] * np.cumsum(spread[:, kept:] ** 2, axis=1))
    names = [
        f"({o[0]},{d},{o[1]})({o[2]},{s},{o[3]})" for o, d, s in zip((orders[k] for k in pick), pdf["d"], pdf["big_d"])
    ]
    yhat = y[:, kept:]
    return pd.DataFrame(
        {
            "series_id": pdf["series_id"], "_last": pdf["_last"], "order": names,
            "yhat": list(yhat), "lower": list(yhat - half), "upper": list(yhat + half),
        }
    )


def _settled(coef: np.ndarray, wild: np.ndarray, own: Sequence[int], at: int) -> np.ndarray:
    """Pull the lag weights of the ``wild`` series in until no root lies outside the unit circle.

    The weight of lag k is divided by r^k, r being the largest root, so all roots move in alike.
    """
    coef = coef.copy()
    if not own:  # shocks alone die out by themselves
        return coef
    for i in np.flatnonzero(wild):
        companion = np.eye(max(own), k=-1)
        companion[0, np.array(own) - 1] = coef[i, at : at + len(own)]
        r = np.abs(np.linalg.eigvals(companion)).max()
        if r > 1:
            coef[i, at : at + len(own)] /= r ** np.array(own, float)
    return coef


def _impulse(phi: np.ndarray, theta: np.ndarray, own: Sequence[int], shocks: Sequence[int], steps: int) -> np.ndarray:
    """Response of the differenced series to one shock, by steps after it."""
    psi = np.zeros((len(phi), steps))
    for h in range(steps):
        psi[:, h] = 1.0 if h == 0 else 0.0
        for i, k in enumerate(shocks):
            if k == h:
                psi[:, h] += theta[:, i]
        for i, k in enumerate(own):
            if k <= h:
                psi[:, h] += phi[:, i] * psi[:, h - k]
    return psi
