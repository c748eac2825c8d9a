"""Seasonal baselines.

Every forecast table has ``series_id, model, h, ts, yhat, model_used``. Template rows
know the horizon steps they serve, so tiling a template over the horizon is an
explode and needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import shift
from tidegrid.operators import stretched
from tidegrid.operators.select import last_ts
from tidegrid.spec import Spec

FORECAST_COLUMNS = ("series_id", "model", "h", "ts", "yhat", "model_used")


def future_index(regular: DataFrame, spec: Spec, steps: int) -> DataFrame:
    """The ``steps`` stamps after the last one of each series."""
    last = regular.where(F.col("pos") == F.col("n") - 1)
    ahead = last.select("series_id", "ts", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("h"))
    return ahead.select("series_id", "h", shift("ts", F.col("h"), spec.step).alias("ts"))


def _steps_served(slot: Column, short: Column, spec: Spec, steps: int) -> Column:
    """Horizon steps of a template slot: every period-th one, or all of them when short."""
    first = (slot + 1).cast("int")
    stride = F.when(short, F.lit(1)).otherwise(F.lit(spec.period))
    return F.when(first <= steps, F.sequence(first, F.lit(steps), stride))


def _as_forecast(df: DataFrame, spec: Spec, model: str) -> DataFrame:
    return df.select(
        "series_id",
        F.lit(model).alias("model"),
        "h",
        shift("_last", F.col("h"), spec.step).alias("ts"),
        F.col("value").alias("yhat"),
        F.when(F.col("n") < spec.period, F.lit("persistence")).otherwise(F.lit(model)).alias("model_used"),
    )


def seasonal_naive(
    regular: DataFrame, spec: Spec, steps: int | None = None, k: int = 0, model: str | None = None
) -> DataFrame:
    """Repeat the last season (k = 0) or the mean of the last k seasons per slot.

    A slot is the position in the tail modulo the period, not the time of day, so a
    tail that is not a whole number of seasons shifts the phase. A series shorter than
    one season repeats its last value and says so in ``model_used``.
    """
    steps = spec.horizon if steps is None else steps
    if steps < 1:
        raise ValueError("steps must be positive")
    model = model or ("seasonal_naive" if k <= 0 else f"kday_average_{k}")
    short = F.col("n") < spec.period
    tail = F.least(F.col("n"), F.lit(spec.period * max(k, 1)))
    offset = F.col("pos") - (F.col("n") - tail)
    if stretched.reaches(regular, spec.period * max(k, 1) - 1):
        rows = _newest_seasons(regular, spec, k, short, tail)
        served = rows.withColumn("h", F.explode(_steps_served(F.col("_slot"), short, spec, steps)))
        return _as_forecast(served, spec, model)
    slot = F.when(~short, F.pmod(offset, F.lit(spec.period))).when(F.col("pos") == F.col("n") - 1, F.lit(0))
    rows = regular.where(F.col("pos") >= F.col("n") - tail).select(
        "series_id", "n", "value", slot.alias("_slot"), last_ts(spec).alias("_last")
    ).where("_slot IS NOT NULL")
    if k > 0:
        rows = rows.groupBy("series_id", "n", "_last", "_slot").agg(F.avg("value").alias("value"))
    served = rows.withColumn("h", F.explode(_steps_served(F.col("_slot"), short, spec, steps)))
    return _as_forecast(served, spec, model)


def _newest_seasons(regular: DataFrame, spec: Spec, k: int, short: Column, tail: Column) -> DataFrame:
    """Template rows of a table that carries its stretches: the last row of a series has its tail beside it."""
    slots = F.when(short, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(spec.period - 1)))
    last = regular.where(F.col("pos") == F.col("n") - 1).select("*", F.explode(slots).alias("_slot"))
    cells = []
    for season in range(max(k, 1)):
        place = F.col("_slot") + season * spec.period
        cells.append(F.when(place < tail, stretched.back(tail - 1 - place)))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cells[1:]), cells[0])
    mean = total / sum((c.isNotNull().cast("int") for c in cells[1:]), F.lit(1))
    value = F.when(short, F.col("value")).otherwise(mean if k > 0 else cells[0])
    return last.select("series_id", "n", value.alias("value"), "_slot", last_ts(spec).alias("_last"))


def slot_averages(regular: DataFrame, spec: Spec, k: int) -> DataFrame:
    """Mean per tail slot over the last k seasons, for series with at least one season."""
    tail = F.least(F.col("n"), F.lit(spec.period * k))
    offset = F.col("pos") - (F.col("n") - tail)
    rows = regular.where((F.col("n") >= spec.period) & (offset >= 0))
    return rows.groupBy("series_id", F.pmod(offset, F.lit(spec.period)).alias("slot")).agg(
        F.avg("value").alias("mean_value")
    )


def persistence(regular: DataFrame, spec: Spec, steps: int | None = None) -> DataFrame:
    """Repeat the last value."""
    steps = spec.horizon if steps is None else steps
    last = regular.where(F.col("pos") == F.col("n") - 1)
    ahead = last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    return ahead.select(
        "series_id",
        F.lit("persistence").alias("model"),
        "h",
        shift("ts", F.col("h"), spec.step).alias("ts"),
        F.col("value").alias("yhat"),
        F.lit("persistence").alias("model_used"),
    )


def with_fallback(regular: DataFrame, spec: Spec, min_rows: int, model, steps: int | None = None) -> DataFrame:
    """``model`` for series with enough history, the K-day average for the others.

    The choice depends on the row count alone; errors of the model are not hidden.
    """
    steps = spec.horizon if steps is None else steps
    enough = model(regular.where(F.col("n") >= min_rows), spec, steps)
    rest = seasonal_naive(regular.where(F.col("n") < min_rows), spec, steps, k=spec.k_days)
    return enough.unionByName(rest)


def ensemble_mean(forecasts: DataFrame, model: str = "ensemble_mean") -> DataFrame:
    """Mean of all models per series and stamp."""
    means = forecasts.groupBy("series_id", "h", "ts").agg(F.avg("yhat").alias("yhat"))
    return means.select("series_id", F.lit(model).alias("model"), "h", "ts", "yhat", F.lit(model).alias("model_used"))
