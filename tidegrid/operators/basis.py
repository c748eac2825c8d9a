"""Trend and season as basis functions that can be carried on past the last row.

Per series, values are regressed on powers of time and on sines and cosines of the day and the
week. The sums of products have a fixed width and are aggregated in the JVM; Python solves one small
system per series. The trend is the polynomial part, the season the harmonic part; both exist at
every row, the ends included, and ahead of the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import shift
from tidegrid.operators.arma import spread
from tidegrid.operators.baseline import seasonal_naive
from tidegrid.operators.regression import NORMAL_95
from tidegrid.operators.select import last_ts
from tidegrid.spec import Spec

#: Seasons of the slow cycle: a week of days.
SEASONS = 7


def basis(at: Column, n: Column, spec: Spec, degree: int, daily: int, weekly: int) -> tuple[list[Column], list[Column]]:
    """Trend and season functions at position ``at`` of a series of ``n`` rows; time runs from 0 to 1."""
    u = at / F.greatest(n - 1, F.lit(1))
    trend = [F.lit(1.0)]
    for _ in range(degree):
        trend.append(trend[-1] * u)
    season = []
    for count, length in ((daily, spec.period), (weekly, SEASONS * spec.period)):
        for k in range(1, count + 1):
            angle = F.lit(2 * np.pi * k / length) * F.pmod(at, F.lit(length))
            season += [F.sin(angle), F.cos(angle)]
    return trend, season


def _needed(spec: Spec, degree: int, daily: int, weekly: int) -> int:
    """Rows a fit needs: whole cycles of what it contains, and twice as many rows as functions."""
    cycle = SEASONS * spec.period if weekly else spec.period if daily else 1
    return max(cycle, 2 * (1 + degree + 2 * (daily + weekly)))


def basis_fit(regular: DataFrame, spec: Spec, degree: int = 2, daily: int = 3, weekly: int = 1) -> DataFrame:
    """Per series: weights ``b``, the residual variance ``sigma2`` and ``inverse``, row by row.

    ``inverse`` is that of the sums of products, for the uncertainty of the weights. Functions that
    a series cannot tell apart share their weight. Rows without a value do not count.
    """
    trend, season = basis(F.col("pos"), F.col("n"), spec, degree, daily, weekly)
    z = [*trend, *season, F.col("value")]
    width = len(z)
    sums = [F.sum(z[i] * z[j]) for i in range(width) for j in range(i, width)]
    rows = regular.where((F.col("n") >= _needed(spec, degree, daily, weekly)) & F.col("value").isNotNull())
    grams = rows.groupBy("series_id", "n", last_ts(spec).alias("_last")).agg(F.count(F.lit(1)).alias("m"), F.array(*sums).alias("gram"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(width)
        for pdf in batches:
            if not len(pdf):
                continue
            full = np.zeros((len(pdf), width, width))
            full[:, upper[0], upper[1]] = np.stack(pdf["gram"].to_numpy())
            full = full + np.transpose(np.triu(full, 1), (0, 2, 1))
            inverse = np.linalg.pinv(full[:, :-1, :-1], hermitian=True)
            b = np.einsum("sij,sj->si", inverse, full[:, :-1, -1])
            rss = np.maximum(full[:, -1, -1] - np.einsum("si,si->s", b, full[:, :-1, -1]), 0.0)
            yield pd.DataFrame(
                {
                    "series_id": pdf["series_id"], "n": pdf["n"], "_last": pdf["_last"], "b": list(b),
                    "sigma2": rss / np.maximum(pdf["m"].to_numpy(float) - (width - 1), 1), "inverse": list(inverse.reshape(len(pdf), -1)),
                }
            )

    key = regular.schema["series_id"].dataType.simpleString()
    return grams.mapInPandas(
        solve, f"series_id {key}, n bigint, _last timestamp_ntz, b array<double>, sigma2 double, inverse array<double>"
    )


def _weighted(functions: list[Column], first: int) -> Column:
    return sum((F.col("b")[first + i] * f for i, f in enumerate(functions)), F.lit(0.0))


def basis_forecast(
    regular: DataFrame, spec: Spec, steps: int | None = None, *, degree: int = 2, daily: int = 3, weekly: int = 1, model: str = "basis"
) -> DataFrame:
    """Trend and season carried on, with a 95 % interval of both noise and weights.

    The interval widens with the distance from the data, as the polynomial part does. Adds
    ``trend``, ``season`` (their sum is ``yhat``), ``lower`` and ``upper``. A series shorter than the
    longest cycle gets the K-day average, named in ``model_used``, and NULL for the rest.
    """
    steps = spec.horizon if steps is None else steps
    fits = basis_fit(regular, spec, degree, daily, weekly)
    asked = fits.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("h"))
    trend, season = basis(F.col("n") - 1 + F.col("h"), F.col("n"), spec, degree, daily, weekly)
    known = asked.select(
        "*", _weighted(trend, 0).alias("trend"), _weighted(season, len(trend)).alias("season"), F.array(*trend, *season).alias("_x")
    )
    width = len(trend) + len(season)
    # x' inverse x, one row of the inverse after the other
    rows = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.slice("inverse", i * width + 1, F.lit(width)))
    dots = F.transform(rows, lambda r: F.aggregate(F.zip_with(r, F.col("_x"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
    spreading = F.aggregate(F.zip_with(dots, F.col("_x"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    half = F.lit(NORMAL_95) * F.sqrt(F.col("sigma2") * (1 + F.greatest(spreading, F.lit(0.0))))
    yhat = F.col("trend") + F.col("season")
    found = known.select(
        "series_id", F.lit(model).alias("model"), "h", shift("_last", F.col("h"), spec.step).alias("ts"), yhat.alias("yhat"),
        F.lit(model).alias("model_used"), "trend", "season", (yhat - half).alias("lower"), (yhat + half).alias("upper"),
    )
    short = regular.where(F.col("n") < _needed(spec, degree, daily, weekly))
    rest = seasonal_naive(short, spec, steps, k=spec.k_days).withColumn("model", F.lit(model))
    return found.unionByName(rest, allowMissingColumns=True)


def basis_decompose(regular: DataFrame, spec: Spec, degree: int = 2, daily: int = 3, weekly: int = 1) -> DataFrame:
    """Trend, season and remainder of every row, the ends included; series too short for a fit are left out."""
    fits = basis_fit(regular, spec, degree, daily, weekly).select("series_id", "b")
    rows = spread(regular.select("series_id", "ts", "value", "pos", "n"), fits, spec)
    trend, season = basis(F.col("pos"), F.col("n"), spec, degree, daily, weekly)
    parts = rows.select("series_id", "ts", "value", _weighted(trend, 0).alias("trend"), _weighted(season, len(trend)).alias("season"))
    return parts.withColumn("remainder", F.col("value") - F.col("trend") - F.col("season"))
