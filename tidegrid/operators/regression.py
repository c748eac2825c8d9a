"""Regression forecasters, decomposition and a stationarity test.

Model fitting is reduced to sums of products, which Spark aggregates with map-side
partials. Python sees one row of sums per series (or per horizon step), never the
rows of a group. The only Python code is the solving of those small systems.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.functions.calendar import is_weekend
from tidegrid.functions.timegrid import shift
from tidegrid.operators import stretched
from tidegrid.operators.align import lag_fallback
from tidegrid.operators.baseline import seasonal_naive
from tidegrid.operators.chunked import dealt, with_halo
from tidegrid.operators.features import feature_matrix
from tidegrid.operators.scaling import minmax_fit, minmax_transform, scaled as on_scale
from tidegrid.operators.select import gates, last_ts
from tidegrid.operators.windows import lagged, step_pairs
from tidegrid.spec import Spec

# Two-sided 95 % normal quantile, 5 % critical value of the Dickey-Fuller test
# with a constant.
NORMAL_95 = 1.959963984540054
DICKEY_FULLER_5 = -2.86


def _forecast_rows(df: DataFrame, spec: Spec, model: str, *extra: str) -> DataFrame:
    return df.select(
        "series_id",
        F.lit(model).alias("model"),
        F.col("h").cast("int").alias("h"),
        shift("_last", F.col("h"), spec.step).alias("ts"),
        "yhat",
        F.lit(model).alias("model_used"),
        *extra,
    )


def _substitute(regular: DataFrame, spec: Spec, steps: int, model: str) -> DataFrame:
    """The K-day average for series too short for ``model``; ``model_used`` names what it is."""
    rows = seasonal_naive(regular, spec, steps, k=spec.k_days)
    return rows.withColumn("model", F.lit(model))


def _whole(rows: Column, wanted: Column, value: Column, model: str) -> Column:
    """``value``, or an error if a series has fewer ``rows`` than it says, as a table cut to its tail has."""
    text = F.concat(F.lit(f"{model} needs whole series: "), rows.cast("string"), F.lit(" of "), wanted.cast("string"))
    return F.when(rows < wanted, F.raise_error(text)).otherwise(value)


def _since(spec: Spec, seasons: int | None) -> Column:
    """First position that counts when only the newest ``seasons`` are to be fitted."""
    return F.lit(0) if seasons is None else F.greatest(F.lit(0), F.col("n") - seasons * spec.period)


# --- first-order autoregression, built-in aggregates only -------------------------


def ar1(
    regular: DataFrame, spec: Spec, steps: int | None = None, model: str = "ar1", train_seasons: int | None = None
) -> DataFrame:
    """y(t) = a + b y(t-1), fitted per series and rolled out.

    All history counts, or the newest ``train_seasons``. A series that is constant or has one row
    repeats its last value.
    """
    steps = spec.horizon if steps is None else steps
    pairs = step_pairs(regular, spec).select(
        "series_id", "pos", "n", "value", last_ts(spec).alias("_last"),
        F.when(F.col("pos") > _since(spec, train_seasons), F.col("value_lag1")).alias("x"),
    )
    fit = pairs.groupBy("series_id", "_last").agg(
        F.regr_slope("value", "x").alias("b"),
        F.regr_intercept("value", "x").alias("a"),
        _whole(F.count(F.lit(1)), F.max("n"), F.max_by("value", "pos"), model).alias("y"),
    )
    # No slope (constant or single row): the last value is the forecast.
    known = fit.withColumns(
        {"a": F.when(F.col("b").isNull(), F.col("y")).otherwise(F.col("a")), "b": F.coalesce("b", F.lit(0.0))}
    )
    path = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.array("y"),
        lambda acc, _: F.concat(acc, F.array(F.col("a") + F.col("b") * F.element_at(acc, -1))),
    )
    rolled = known.select("series_id", "_last", F.posexplode(path).alias("h", "yhat")).where("h > 0")
    return _forecast_rows(rolled, spec, model)


# --- autoregression with order search and exogenous columns ------------------------


def _lags(max_p: int, period: int) -> tuple[list[int], list[int]]:
    """Lags of the series and of the covariates that the candidate orders read."""
    near = range(max_p + 3)
    return sorted({k + s for k in near for s in (0, period)} - {0}), [k + s for s in (0, period) for k in range(3)]


def _candidates(max_p: int, period: int, n_exog: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Models as restrictions of one regression on the constant, the lags and the covariates' lags.

    A model is ``coef = base + free @ theta``. Differencing (regular and seasonal) fixes lag weights
    in ``base`` and ties others in ``free``, for the covariates as for the series, so every model
    predicts the same value from the same columns on the same rows, and AIC values compare.
    """
    lags, exog_lags = _lags(max_p, period)
    at = {lag: 1 + i for i, lag in enumerate(lags)}
    width = 1 + len(lags) + n_exog * len(exog_lags)

    def weights(poly: dict[int, float], by: int = 0) -> np.ndarray:
        """Lag weights of the differenced series ``by`` steps back."""
        v = np.zeros(width)
        for k, c in poly.items():
            if k + by > 0:
                v[at[k + by]] += c
        return v

    def covariate(poly: dict[int, float], j: int) -> np.ndarray:
        v = np.zeros(width)
        for k, c in poly.items():
            v[1 + len(lags) + j * len(exog_lags) + exog_lags.index(k)] += c
        return v

    plain = [{0: 1.0}, {0: 1.0, 1: -1.0}, {0: 1.0, 1: -2.0, 2: 1.0}]
    out = []
    for d, poly in enumerate(plain):
        for seasonal_lag, seasonal_difference in ((0, 0), (1, 0), (0, 1)):
            diff = dict(poly)
            if seasonal_difference:
                diff |= {k + period: -c for k, c in poly.items()}
            for p in range(max_p + 1):
                free = [] if d else [np.eye(width)[0]]
                free += [weights(diff, i) for i in range(1, p + 1)]
                free += [weights(diff, period)] if seasonal_lag else []
                free += [covariate(diff, j) for j in range(n_exog)]
                name = f"({p},{d},0)({seasonal_lag},{seasonal_difference},0)"
                out.append((name, -weights(diff), np.array(free).reshape(-1, width).T))
    return out


def ar_fit(
    regular: DataFrame, spec: Spec, max_p: int, exog_cols: Sequence[str] = (), train_seasons: int | None = None
) -> DataFrame:
    """Sums of products per series, and its newest rows.

    ``gram`` is the upper triangle over (1, lags..., covariates' lags..., y), row by row; ``recent``
    and ``recent_exog`` hold the last values, oldest first. Lags cross chunk borders by copies, so
    no task holds a series. A missing covariate counts as 0.
    """
    lags, exog_lags = _lags(max_p, spec.period)
    depth = max(lags)
    exog = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in exog_cols]
    table = regular.select("series_id", "ts", "pos", "n", "value", *exog)
    beside = not exog_cols and stretched.reaches(regular, depth)
    if beside:
        rows = lagged(regular.select("series_id", "ts", "pos", "n", "value", *stretched.columns(regular)), "value", lags, spec)
    else:
        one = table.select("series_id", "ts", "pos", "n", F.struct("value", *exog_cols).alias("_row"))
        back = sorted({*lags, *exog_lags} - {0}) if exog_cols else lags
        rows = lagged(one, "_row", back, spec)
    rows = rows.where(F.col("pos") >= depth + _since(spec, train_seasons))

    def cell(lag: int, name: str) -> Column:
        if beside:
            return F.col(f"value_lag{lag}" if lag else "value")
        return F.col(f"_row_lag{lag}.{name}" if lag else f"_row.{name}")

    z = [F.lit(1.0), *[cell(k, "value") for k in lags], *[cell(k, c) for c in exog_cols for k in exog_lags], cell(0, "value")]
    products = [F.sum(z[i] * z[j]) for i in range(len(z)) for j in range(i, len(z))]
    # Plain sums and the lists are aggregated apart: a list would take the sums off the
    # generated hash aggregation.
    m = F.count(F.lit(1))
    wanted = F.max(F.col("n") - depth - _since(spec, train_seasons))
    sums = rows.groupBy("series_id", last_ts(spec).alias("_last")).agg(
        _whole(m, wanted, m, "ar_forecast").alias("m"), F.array(*products).alias("gram")
    )
    if beside:
        recent = regular.where(F.col("pos") == F.col("n") - 1).select(
            "series_id", stretched.newest(depth).alias("recent"), F.array().cast("array<double>").alias("recent_exog")
        )
        return sums.join(dealt(recent), "series_id")
    recent = table.where(F.col("pos") >= F.col("n") - depth).groupBy("series_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value", F.array(*exog_cols).cast("array<double>").alias("x")))).alias("r")
    )
    recent = recent.select(
        "series_id",
        F.transform("r", lambda r: r["value"]).alias("recent"),
        F.flatten(F.transform("r", lambda r: r["x"])).alias("recent_exog"),
    )
    return sums.join(dealt(recent), "series_id")


def ar_forecast(
    regular: DataFrame,
    spec: Spec,
    steps: int | None = None,
    *,
    max_p: int = 2,
    exog_cols: Sequence[str] = (),
    future: DataFrame | None = None,
    model: str = "ar_p",
    min_rows: int | None = None,
    train_seasons: int | None = None,
) -> DataFrame:
    """Autoregression with the order of lowest AIC, a 95 % interval, and optional covariates.

    Orders: up to ``max_p`` lags, up to two differences, and a seasonal lag or a seasonal difference
    with any of them; covariates are differenced like the series. An order needs more rows than it
    has parameters. ``regular`` holds the covariates, ``future`` their values for ``h = 1..steps``.
    Series with fewer than ``min_rows`` (by default the gate for autoregressions) get the K-day
    average, named in ``model_used``. Adds ``lower``, ``upper`` and ``order``, NULL for those.
    """
    steps = spec.horizon if steps is None else steps
    lags, exog_lags = _lags(max_p, spec.period)
    n_lags, n_exog, n_back, depth, period = len(lags), len(exog_cols), len(exog_lags), max(lags), spec.period
    need = max(depth + 3, gates(spec)["autoregression"] if min_rows is None else min_rows)
    sums = ar_fit(regular.where(F.col("n") >= need), spec, max_p, exog_cols, train_seasons)
    if exog_cols:
        if future is None:
            raise ValueError("exogenous columns need their future values")
        # At most ``steps`` rows per series.
        ahead = future.where(F.col("h") <= steps).groupBy("series_id").agg(
            F.sort_array(F.collect_list(F.struct("h", F.array(*exog_cols).cast("array<double>").alias("x")))).alias("_x")
        )
        flat = F.flatten(F.transform("_x", lambda r: F.transform(r["x"], lambda v: F.coalesce(v, F.lit(0.0)))))
        sums = sums.join(dealt(ahead.select("series_id", flat.alias("future"))), "series_id", "left")
        enough = F.coalesce(F.size("future"), F.lit(0)) == steps * n_exog
        sums = sums.withColumn("future", F.when(enough, F.col("future")).otherwise(F.raise_error(F.lit(f"{model} lacks future covariates"))))
    else:
        sums = sums.withColumn("future", F.array().cast("array<double>"))
    width = 2 + n_lags + n_exog * n_back

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = _candidates(max_p, period, n_exog)
        upper = np.triu_indices(width)
        series_at = [*range(1, 1 + n_lags), width - 1]
        for pdf in batches:
            if not len(pdf):
                continue
            size = len(pdf)
            full = np.zeros((size, width, width))
            full[:, upper[0], upper[1]] = np.stack(pdf["gram"].to_numpy())
            full = full + np.transpose(np.triu(full, 1), (0, 2, 1))
            m = pdf["m"].to_numpy(dtype=float)
            # Centre the series by its mean, so that the systems are well conditioned.
            level = full[:, 0, -1] / m
            shift_by = np.tile(np.eye(width), (size, 1, 1))
            shift_by[:, series_at, 0] = -level[:, None]
            full = shift_by @ full @ np.transpose(shift_by, (0, 2, 1))
            gram, gy, yy = full[:, :-1, :-1], full[:, :-1, -1], full[:, -1, -1]
            best_aic = np.full(size, np.inf)
            coef, sigma2 = np.zeros((size, width - 1)), np.zeros(size)
            order = np.full(size, "", dtype=object)
            for name, base, free in models:
                b = np.tile(base, (size, 1))
                if free.shape[1]:
                    inner = free.T @ gram @ free
                    b = b + np.einsum("sij,sj->si", np.linalg.pinv(inner, hermitian=True), (gy - gram @ base) @ free) @ free.T
                rss = yy - 2 * np.einsum("si,si->s", b, gy) + np.einsum("si,sij,sj->s", b, gram, b)
                rss = np.maximum(rss, 1e-12 * np.maximum(yy, 1e-12))
                aic = np.where(m > free.shape[1] + 1, m * np.log(rss / m) + 2 * free.shape[1], np.inf)
                better = aic < best_aic
                best_aic = np.where(better, aic, best_aic)
                coef[better], order[better] = b[better], name
                sigma2[better] = (rss / np.maximum(m - free.shape[1], 1))[better]
            path = np.zeros((size, depth + steps))
            impulse = np.zeros((size, depth + steps))
            path[:, :depth] = np.stack(pdf["recent"].to_numpy()) - level[:, None]
            impulse[:, depth] = 1.0
            lag_coef = coef[:, 1 : 1 + n_lags]
            exog_coef = coef[:, 1 + n_lags :].reshape(size, n_exog, n_back)
            if n_exog:
                known = [np.stack(pdf[c].to_numpy()).reshape(size, -1, n_exog) for c in ("recent_exog", "future")]
                exog = np.concatenate(known, axis=1)
            for h in range(steps):
                back = depth + h - np.array(lags)
                path[:, depth + h] = coef[:, 0] + np.einsum("sl,sl->s", lag_coef, path[:, back])
                if n_exog:
                    path[:, depth + h] += np.einsum("sjl,slj->s", exog_coef, exog[:, depth + h - np.array(exog_lags)])
                if h:
                    impulse[:, depth + h] = np.einsum("sl,sl->s", lag_coef, impulse[:, back])
            yhat = path[:, depth:] + level[:, None]
            half = NORMAL_95 * np.sqrt(sigma2[:, None] * np.cumsum(impulse[:, depth:] ** 2, axis=1))
            yield pd.DataFrame(
                {
                    "series_id": pdf["series_id"],
                    "_last": pdf["_last"],
                    "order": order,
                    "yhat": list(yhat),
                    "lower": list(yhat - half),
                    "upper": list(yhat + half),
                }
            )

    key = sums.schema["series_id"].dataType.simpleString()
    schema = (
        f"series_id {key}, _last timestamp_ntz, order string, yhat array<double>, lower array<double>, upper array<double>"
    )
    # Only ship what the solver reads.
    shipped = ["series_id", "_last", "m", "gram", "recent", "recent_exog", "future"]
    solved = sums.select(*shipped).mapInPandas(solve, schema)
    steps_col = F.sequence(F.lit(1), F.lit(steps)).alias("h")
    zipped = solved.select("series_id", "_last", "order", F.arrays_zip(steps_col, "yhat", "lower", "upper").alias("z"))
    rolled = zipped.select("series_id", "_last", "order", F.inline("z"))
    found = _forecast_rows(rolled, spec, model, "lower", "upper", "order")
    rest = _substitute(regular.where(F.col("n") < need), spec, steps, model)
    return found.unionByName(rest, allowMissingColumns=True)


# --- pooled one-step regression, rolled out recursively -----------------------------


def _solved(sums: DataFrame, keys: str, width: int) -> DataFrame:
    """Least squares from rows of ``gram`` sums, upper triangles of (x..., y): the coefficients ``b``."""
    names = [k.split(" ")[0] for k in keys.split(", ") if k]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(width)
        for pdf in batches:
            pdf = pdf[[g is not None and g[0] is not None and not np.isnan(g[0]) for g in pdf["gram"]]]
            if not len(pdf):
                continue
            full = np.zeros((len(pdf), width, width))
            full[:, upper[0], upper[1]] = np.stack([np.asarray(g, float) for g in pdf["gram"]])
            full = full + np.transpose(np.triu(full, 1), (0, 2, 1))
            inverse = np.linalg.pinv(full[:, :-1, :-1], hermitian=True)
            b = np.einsum("sij,sj->si", inverse, full[:, :-1, -1])
            yield pd.DataFrame({**{k: pdf[k].to_numpy() for k in names}, "b": list(b)})

    return sums.mapInPandas(solve, f"{keys}{', ' if keys else ''}b array<double>")


def _grams(z: Sequence[Column]) -> Column:
    return F.array(*[F.sum(z[i] * z[j]) for i in range(len(z)) for j in range(i, len(z))])


def lag_recursive(
    regular: DataFrame,
    weather: DataFrame | None,
    spec: Spec,
    steps: int | None = None,
    *,
    lags: Sequence[int] | None = None,
    days: int | None = None,
    cap: int | None = None,
    share: float = 1.0,
    scaler_share: float | None = None,
    exog_future: str = "freeze",
    model: str = "lag_recursive",
) -> DataFrame:
    """One linear model for all series on scaled lags, predicting one step at a time.

    Features are demand at ``lags`` plus weekend and temperature of the previous row. All samples
    train; ``days`` and ``cap`` keep the newest of each series, ``share`` the first part of them, and
    ``scaler_share`` has the scaler see only that part of a series. In the rollout weekend and
    temperature stay at their last values (``freeze``), the weekend follows the calendar
    (``calendar``), or the temperature also comes from a year or a week ago (``asof``). A series
    with fewer feature rows than the deepest lag gets the K-day average, named in ``model_used``.
    """
    if exog_future not in ("freeze", "calendar", "asof"):
        raise ValueError(f"unknown exog_future: {exog_future}")
    steps = spec.horizon if steps is None else steps
    lags = list(lags or (1, spec.period, 7 * spec.period))
    depth = max(lags)
    cols = ["demand", "is_weekend", "temperature_2m"]
    recent = feature_matrix(regular, weather, spec, days)
    scaler = minmax_fit(recent, cols, scaler_share)
    scaler = scaler.withColumn("demand_min", _whole(F.col("n_rows"), F.col("n"), F.col("demand_min"), model))
    # Without weather the features are the rows of the demand, and end with it.
    whole = weather is None and days is None
    beside = whole and stretched.reaches(regular, depth)
    if beside:
        known = [c for c in scaler.columns if c not in ("series_id", "n", "n_rows")] + list(stretched.COLUMNS)
        rows = stretched.scaled_rows(regular.where(F.col("n") >= depth), scaler, "demand", spec, on_scale)
        scaled = feature_matrix(rows, None, spec, keep=known)
        scaled = scaled.withColumns({c: on_scale(F.col(c), c) for c in cols if c != "demand"})
    else:
        scaled = minmax_transform(recent, scaler, cols, spec.chunk)

    newest = F.lit(0) if cap is None else F.greatest(F.lit(0), F.col("n") - cap)
    first = F.greatest(F.lit(depth), newest)
    kept = scaled if cap is None else scaled.where(F.col("pos") >= F.greatest(F.lit(0), F.col("n") - cap - depth))
    if beside:
        # The weekend follows from the stamp, and the temperature is the same everywhere.
        then = is_weekend(shift("ts", F.lit(-min(lags)), spec.step)).cast("double")
        samples = kept.where(F.col("pos") >= first)
        z = [
            F.lit(1.0),
            *[stretched.back(k) for k in lags],
            on_scale(then, "is_weekend"),
            F.col("temperature_2m"),
            F.col("demand"),
        ]
    else:
        one = kept.select("series_id", "pos", "n", F.struct(*cols).alias("_row"))
        samples = lagged(one, "_row", lags, spec).where(F.col("pos") >= first)
        nearest = f"_row_lag{min(lags)}"
        z = [
            F.lit(1.0),
            *[F.col(f"_row_lag{k}.demand") for k in lags],
            F.col(f"{nearest}.is_weekend"),
            F.col(f"{nearest}.temperature_2m"),
            F.col("_row.demand"),
        ]
    train = samples.where(F.col("pos") - first < F.floor(F.lit(share) * (F.col("n") - first)))
    names = [f"_z{i}" for i in range(len(z))]
    train = train.select(*[c.alias(name) for c, name in zip(z, names)])
    # One row of sums, one row of coefficients: a scalar subquery, nothing runs before the result does.
    b = _solved(train.agg(_grams([F.col(name) for name in names]).alias("gram")), "", len(z)).select("b").scalar()

    scales = ["demand_min", "demand_max", "is_weekend_min", "is_weekend_max"]
    if beside:
        state = scaled.where(F.col("pos") == F.col("n") - 1).select(
            "series_id", *scales, stretched.newest(depth).alias("_past"), F.col("is_weekend").alias("_weekend"),
            F.col("temperature_2m").alias("_temperature"), F.col("ts").alias("_from"),
        )
    else:
        state = scaled.where(F.col("pos") >= F.col("n") - depth).groupBy("series_id", *scales).agg(
            F.sort_array(F.collect_list(F.struct("pos", "demand"))).alias("_past"),
            F.max_by("is_weekend", "pos").alias("_weekend"),
            F.max_by("temperature_2m", "pos").alias("_temperature"),
            F.max("ts").alias("_from"),
        ).withColumn("_past", F.transform("_past", lambda r: r["demand"]))
    state = state.where(F.size("_past") == depth).withColumn("_b", b)
    if whole:
        state = state.withColumns({"_last": F.col("_from"), "_behind": F.lit(0)})
    else:
        ends = regular.where(F.col("pos") == F.col("n") - 1).select("series_id", F.col("ts").alias("_last"))
        # Features may end before the demand does; those steps are rolled through and dropped.
        behind = (
            F.unix_seconds(F.col("_last").cast("timestamp")) - F.unix_seconds(F.col("_from").cast("timestamp"))
        ) / spec.step
        state = state.join(dealt(ends), "series_id").withColumn("_behind", behind.cast("int"))
    if exog_future == "asof":
        # One more season than the horizon covers features that end before the demand.
        ahead = lag_fallback(scaled, "temperature_2m", spec, steps + spec.period).groupBy("series_id").agg(
            F.sort_array(F.collect_list(F.struct("h", "temperature_2m"))).alias("_temps")
        )
        state = state.join(dealt(ahead), "series_id").withColumn("_temps", F.transform("_temps", lambda r: r["temperature_2m"]))

    def weekend(h: Column) -> Column:
        """Scaled weekend flag of the row before step h."""
        if exog_future == "freeze":
            return F.col("_weekend")
        lo, hi = F.col("is_weekend_min"), F.col("is_weekend_max")
        flag = is_weekend(shift("_from", h - 1, spec.step)).cast("double")
        # A series without any weekend so far has a constant column, whose range counts as 1.
        moved = (flag - lo) / F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        return F.when(h == 1, F.col("_weekend")).otherwise(moved)

    def temperature(h: Column) -> Column:
        if exog_future != "asof":
            return F.col("_temperature")
        known = (h > 1) & (h - 1 <= F.size("_temps"))
        return F.when(known, F.element_at("_temps", F.greatest(h - 1, F.lit(1)))).otherwise(F.col("_temperature"))

    # The path is a sliding window of fixed length, however far the features end before the demand.
    width = max(depth, steps)

    def step(acc: Column, h: Column) -> Column:
        known = F.col("_b")
        value = known[0] + known[len(lags) + 1] * weekend(h) + known[len(lags) + 2] * temperature(h)
        for i, k in enumerate(lags, 1):
            value = value + known[i] * F.element_at(acc, -k)
        return F.concat(F.slice(acc, 2, width - 1), F.array(value))

    padding = F.array_repeat(F.lit(None).cast("double"), width - depth)
    path = F.aggregate(
        F.sequence(F.lit(1), F.col("_behind") + steps), F.concat(padding, F.col("_past")), step
    )
    ahead = state.select(
        "series_id", "_last", "demand_min", "demand_max", F.posexplode(F.slice(path, -steps, steps)).alias("i", "z")
    )
    rolled = ahead.select(
        "series_id",
        "_last",
        (F.col("i") + 1).alias("h"),
        (F.col("z") * (F.col("demand_max") - F.col("demand_min")) + F.col("demand_min")).alias("yhat"),
    )
    if whole:
        brief = regular.where(F.col("n") < depth)
    else:
        # One row per series says whether its features reach deep enough.
        short = recent.where((F.col("pos") == 0) & (F.col("n") < depth)).select("series_id")
        brief = regular.join(dealt(short), "series_id", "left_semi")
    rest = _substitute(brief, spec, steps, model)
    return _forecast_rows(rolled, spec, model).unionByName(rest)


# --- direct multi-step regression ----------------------------------------------------


def _ceil_div(a: Column, b: int) -> Column:
    return F.ceil(a / F.lit(b)).cast("int")


def direct_horizon(
    regular: DataFrame,
    spec: Spec,
    steps: int | None = None,
    *,
    lookback: int | None = None,
    share: float = 1.0,
    scaler_share: float | None = None,
    exog_cols: Sequence[str] = (),
    future: DataFrame | None = None,
    model: str = "direct_horizon",
) -> DataFrame:
    """All steps at once: one linear model per horizon step, shared by all series.

    Step h is predicted from the last value, the value of the same slot in the last season
    known at the origin, that of the last week, and the covariates of the target (``regular`` holds
    them, ``future`` has them for ``h = 1..steps``; a missing one counts as 0). Values are scaled
    per series, by all rows or the first ``scaler_share``. Every origin with a complete lookback
    and horizon is a sample; ``share`` keeps the first part of each series. The fit needs only
    sums of products per step, so the number of rows that leave the map side does not grow with
    the data. Series shorter than the lookback get the K-day average, named in ``model_used``.
    """
    if exog_cols and future is None:
        raise ValueError("exogenous columns need their future values")
    steps = spec.horizon if steps is None else steps
    period, week = spec.period, 7 * spec.period
    seasons, weeks = -(-steps // period), -(-steps // week)
    # The oldest value any step reads lies one week of steps before its target.
    lookback = max(lookback or 0, week, steps)
    exog = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in exog_cols]
    table = regular.select("series_id", "ts", "pos", "n", "value", *exog)
    scaler = minmax_fit(table, ["value"], scaler_share)
    scaler = scaler.withColumn("value_min", _whole(F.col("n_rows"), F.col("n"), F.col("value_min"), model))
    beside = not exog_cols and stretched.reaches(regular, max(lookback - 1, steps, seasons * period, weeks * week))
    if beside:
        scaled = stretched.scaled_rows(regular.where(F.col("n") >= lookback), scaler, "value", spec, on_scale)
    else:
        scaled = minmax_transform(table.where(F.col("n") >= lookback), scaler, ["value"], spec.chunk)
    # Seen from the target, the seasonal columns are a few fixed lags. Only the last value
    # before the origin needs an array, of ``steps`` rows.
    frames = {"past": lambda w: F.collect_list("value").over(w.rowsBetween(-steps, -1))}
    for i in range(1, seasons + 1):
        frames[f"_season{i}"] = lambda w, k=i * period: F.lag("value", k).over(w)
    for i in range(1, weeks + 1):
        frames[f"_week{i}"] = lambda w, k=i * week: F.lag("value", k).over(w)
    rows = scaled.select("series_id", "pos", "n", "value", *exog_cols, *stretched.columns(scaled))
    targets = rows if beside else with_halo(rows, max(steps, seasons * period, weeks * week), 0, frames, span=spec.chunk)
    # Training origins are first, first + 1, ..., first + train - 1.
    first = F.lit(lookback - 1)
    train = F.floor(F.lit(share) * (F.col("n") - lookback - steps + 1))
    nearest = F.greatest(F.lit(1), F.col("pos") - first - train + 1).cast("int")
    farthest = F.least(F.lit(steps), F.col("pos") - first).cast("int")
    season_values = F.array(*[f"_season{i}" for i in range(1, seasons + 1)])
    week_values = F.array(*[f"_week{i}" for i in range(1, weeks + 1)])

    def pair(h: Column) -> Column:
        return F.struct(
            h.alias("h"),
            F.element_at("past", -h).alias("x1"),
            F.element_at(season_values, _ceil_div(h, period)).alias("x2"),
            F.element_at(week_values, _ceil_div(h, week)).alias("x3"),
            F.col("value").alias("y"),
            *[F.col(c).alias(f"e{j}") for j, c in enumerate(exog_cols)],
        )

    served = targets.where((train > 0) & (nearest <= farthest))
    if beside:
        pairs = served.select("*", F.explode(F.sequence(nearest, farthest)).alias("h"))
        asks = {"x1": F.col("h"), "x2": _ceil_div(F.col("h"), period) * period, "x3": _ceil_div(F.col("h"), week) * week}
        pairs = pairs.select("h", *[stretched.back(k).alias(x) for x, k in asks.items()], F.col("value").alias("y"))
    else:
        pairs = served.select(F.inline(F.transform(F.sequence(nearest, farthest), pair)))
    covariates = [F.col(f"e{j}") for j in range(len(exog_cols))]
    z = [F.lit(1.0), F.col("x1"), F.col("x2"), F.col("x3"), *covariates, F.col("y")]
    coef = _solved(pairs.groupBy("h").agg(_grams(z).alias("gram")), "h int", len(z))
    if beside:
        state = scaled.where(F.col("pos") == F.col("n") - 1).select(
            "series_id", "value_min", "value_max", stretched.newest(lookback).alias("window"), F.col("ts").alias("_last")
        )
    else:
        newest = scaled.where(F.col("pos") >= F.col("n") - lookback)
        state = newest.groupBy("series_id", "value_min", "value_max").agg(
            F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_past"), F.max("ts").alias("_last")
        ).withColumn("window", F.transform("_past", lambda r: r["value"]))

    def ask(h: Column) -> Column:
        def back(length: int) -> Column:
            return F.element_at("window", (F.lit(lookback) + h - _ceil_div(h, length) * length).cast("int"))

        return F.struct(
            h.alias("h"), F.element_at("window", lookback).alias("x1"), back(period).alias("x2"), back(week).alias("x3")
        )

    horizon = F.sequence(F.lit(1), F.lit(steps))
    asked = state.select("series_id", "_last", "value_min", "value_max", F.inline(F.transform(horizon, ask)))
    if exog_cols:
        ahead = future.select(
            "series_id", F.col("h").cast("int").alias("h"),
            *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"e{j}") for j, c in enumerate(exog_cols)],
        )
        asked = asked.join(dealt(ahead), ["series_id", "h"])
    # One row per horizon step: its size is fixed by ``steps``.
    solved = asked.join(F.broadcast(coef), "h")
    z_hat = sum((F.col("b")[i] * x for i, x in enumerate(z[1:-1], 1)), F.col("b")[0])
    rolled = solved.withColumn("yhat", z_hat * (F.col("value_max") - F.col("value_min")) + F.col("value_min"))
    rest = _substitute(regular.where(F.col("n") < lookback), spec, steps, model)
    return _forecast_rows(rolled, spec, model).unionByName(rest)


# --- decomposition and stationarity --------------------------------------------------


def seasonal_decompose(regular: DataFrame, spec: Spec) -> DataFrame:
    """Additive trend, season and remainder.

    The trend is the centred mean over one season (half weights at both ends when the
    period is even) and NULL where the frame is incomplete.
    """
    half, even = spec.period // 2, spec.period % 2 == 0
    rows = regular.select("series_id", "ts", "value", "pos", "n")

    def total(w):
        return F.sum("value").over(w.rowsBetween(-half, half))

    frames = {"_sum": total}
    if even:
        frames |= {"_head": lambda w: F.lag("value", half).over(w), "_tail": lambda w: F.lead("value", half).over(w)}
    framed = with_halo(rows, half, half, frames, span=spec.chunk)
    complete = (F.col("pos") >= half) & (F.col("pos") < F.col("n") - half)
    ends = (F.col("_head") + F.col("_tail")) / 2 if even else F.lit(0.0)
    trend = F.when(complete, (F.col("_sum") - ends) / spec.period)
    slot = F.pmod(F.col("pos"), F.lit(spec.period))
    parts = framed.select("series_id", "ts", "value", slot.alias("slot"), trend.alias("trend"))
    means = parts.groupBy("series_id", "slot").agg(F.avg(F.col("value") - F.col("trend")).alias("_mean"))
    centre = F.avg("_mean").over(W.partitionBy("series_id"))  # one row per slot
    season = means.select("series_id", "slot", (F.col("_mean") - centre).alias("season"))
    joined = parts.join(season, ["series_id", "slot"])
    return joined.select(
        "series_id", "ts", "value", "trend", "season",
        (F.col("value") - F.col("trend") - F.col("season")).alias("remainder"),
    )


def stationarity(regular: DataFrame, spec: Spec) -> DataFrame:
    """Dickey-Fuller statistic per series: regress the change on the previous value."""
    pairs = step_pairs(regular, spec).where("value_lag1 IS NOT NULL")
    change, level = F.col("value") - F.col("value_lag1"), F.col("value_lag1")
    fits = pairs.groupBy("series_id").agg(
        F.regr_slope(change, level).alias("slope"),
        F.regr_sxx(change, level).alias("sxx"),
        F.regr_sxy(change, level).alias("sxy"),
        F.regr_syy(change, level).alias("syy"),
        F.count(F.lit(1)).alias("n"),
    )
    rss = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    error = F.sqrt(F.try_divide(F.try_divide(rss, F.col("n") - 2), F.col("sxx")))
    stat = F.try_divide(F.col("slope"), error)
    return fits.select("series_id", "n", stat.alias("stat"), (stat < DICKEY_FULLER_5).alias("stationary"))
