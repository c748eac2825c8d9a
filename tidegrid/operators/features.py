"""Feature tables for the regression forecasters.

Demand and weather are merged per (series, slot) while both are still small, and one pass
fills the gaps of all columns together. No table of grid size is joined or shuffled.
``demand`` is a raw or a regular table, ``weather`` has its own coarser stamps, at most
one row per slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.calendar import calendar_columns, is_weekend
from tidegrid.functions.timegrid import slot_of, slot_start
from tidegrid.operators.align import lag_fallback
from tidegrid.operators.chunked import explode_slots, with_neighbours
from tidegrid.operators.regularise import clean_bins, constant_fill, filled_value, regularise
from tidegrid.spec import Spec


def add_weekend(table: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """Weekend column as a number: from the flag table (missing means no) or the calendar."""
    if flags is None:
        return table.withColumn("is_weekend", is_weekend(F.col("ts")).cast("double"))
    joined = table.join(flags.select("series_id", "ts", "is_weekend"), ["series_id", "ts"], "left")
    return joined.withColumn("is_weekend", F.coalesce("is_weekend", F.lit(False)).cast("double"))


def _slots(demand: DataFrame, spec: Spec) -> DataFrame:
    if "pos" in demand.columns:
        return demand.select("series_id", slot_of("ts", spec.step).alias("slot"), "value")
    return clean_bins(demand, spec)


def _regular(demand: DataFrame, spec: Spec) -> DataFrame:
    return demand if "pos" in demand.columns else regularise(demand, spec)


def _merged(demand: DataFrame, weather: DataFrame, spec: Spec, measures: Sequence[str]) -> DataFrame:
    """Demand and weather per slot with the neighbours and the extent of every column."""
    stamped = weather.select(
        "series_id", slot_of("ts", spec.step).alias("slot"), *measures, F.lit(1).alias("_weather")
    )
    both = _slots(demand, spec).unionByName(stamped, allowMissingColumns=True)
    cols = ["value", *measures, "_weather"]
    # Each column has at most one value per slot; max picks it.
    merged = both.groupBy("series_id", "slot").agg(*[F.max(c).alias(c) for c in cols])
    return with_neighbours(merged, cols, at="slot", span=spec.chunk, extent=True)


def _grid(near: DataFrame, lo: Column, hi: Column, spec: Spec, values: dict[str, Column]) -> DataFrame:
    """Grid rows of each series between ``lo`` and ``hi``, numbered from 0."""
    start = F.greatest(F.col("slot"), lo)
    stop = F.least(F.coalesce(F.col("next_at") - 1, F.col("slot")), hi)
    grid = explode_slots(near, start, stop, spec.chunk, "at")
    return grid.select(
        "series_id",
        slot_start("at", spec.step).alias("ts"),
        (F.col("at") - lo).alias("pos"),
        (hi - lo + 1).alias("n"),
        *[v.alias(c) for c, v in values.items()],
    )


def _left_filled(demand: DataFrame, weather: DataFrame, spec: Spec, measure: str) -> DataFrame:
    """Every demand row; the measure is interpolated, then padded at both edges.

    Weather that does not overlap the demand at all does not count, nor does that of series
    without demand.
    """
    near = _merged(demand, weather, spec, [measure]).where(F.col("value_first_at").isNotNull())
    lo, hi = F.col("value_first_at"), F.col("value_last_at")
    overlap = (F.col(f"{measure}_first_at") <= hi) & (F.col("_weather_last_at") >= lo)
    padded = F.when(overlap, F.coalesce(filled_value(measure, "linear"), F.col(f"{measure}_next")))
    return _grid(near, lo, hi, spec, {"value": filled_value("value", "linear"), measure: padded})


def regularise_with_flags(raw: DataFrame, spec: Spec, flag: str = "is_weekend", order: str = "ingest_order") -> DataFrame:
    """Readings with a flag to a regular table with ``is_weekend`` as a number, in one pass.

    The flag that came first by ``order`` counts per stamp, the first stamp's per bin, then it is
    carried on; before the first one the next counts. Value and flag are merged per slot before
    either is put on the grid. ``raw`` has ``series_id, ts, value`` and the flag.
    """
    usable = F.when(~F.isnan("value"), F.col("value"))
    stamps = raw.where(F.col("ts").isNotNull()).groupBy("series_id", "ts").agg(
        F.avg(usable).alias("value"), F.min_by(flag, order).alias("_flag")
    )
    bins = stamps.groupBy("series_id", slot_of("ts", spec.step).alias("slot")).agg(
        F.avg("value").alias("value"), F.min_by("_flag", "ts").alias("_flag")
    )
    near = with_neighbours(bins, ["value", "_flag"], at="slot", span=spec.chunk, extent=True)
    near = near.where(F.col("value_first_at").isNotNull())
    carried = F.coalesce("_flag_prev", "_flag_next", F.lit(False)).cast("double")
    values = {"value": filled_value("value", "linear"), "is_weekend": carried}
    table = _grid(near, F.col("value_first_at"), F.col("value_last_at"), spec, values)
    return table.select("series_id", "ts", "value", "is_weekend", "pos", "n")


def exog_matrix(
    demand: DataFrame, weather: DataFrame | None, spec: Spec, flags: DataFrame | None = None
) -> DataFrame:
    """Demand, weekend and temperature on every demand row; weather gaps are filled.

    The temperature of a series without any weather is NULL in all its rows.
    """
    if weather is None:
        table = add_weekend(_regular(demand, spec), flags).withColumnRenamed("value", "demand")
        return table.select("series_id", "ts", "pos", "n", "demand", "is_weekend")
    table = add_weekend(_left_filled(demand, weather, spec, "temperature_2m"), flags)
    named = table.withColumnRenamed("value", "demand")
    return named.select("series_id", "ts", "pos", "n", "demand", "is_weekend", "temperature_2m")


def covariates(
    demand: DataFrame, weather: DataFrame | None, spec: Spec, flags: DataFrame | None = None
) -> DataFrame:
    """Weekend and temperature on the demand grid; 0.0 where a series has no weather."""
    if weather is None:
        table = _regular(demand, spec).withColumn("temperature_2m", F.lit(0.0))
    else:
        table = constant_fill(_left_filled(demand, weather, spec, "temperature_2m"), {"temperature_2m": 0.0})
    return add_weekend(table, flags).select("series_id", "ts", "pos", "n", "is_weekend", "temperature_2m")


def feature_matrix(
    demand: DataFrame,
    weather: DataFrame | None,
    spec: Spec,
    days: int | None = None,
    measures: Sequence[str] = ("temperature_2m",),
    calendar: bool = False,
    flags: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Complete rows of demand, weekend and weather, optionally with calendar columns.

    Only stamps inside the weather stay, and with ``days`` only those at most so long before the
    last demand. A series without weather, or whose weather lies wholly outside its demand, keeps
    all its stamps, and so does every series if ``weather`` is None; the measures are 0.0 there. A
    measure that a series lacks altogether is 0.0 too. What stays has no gaps, so ``pos`` and
    ``n`` follow from its first and last slot. ``keep`` names columns of a regular table that stay
    if ``weather`` is None.
    """
    back = None if days is None else days * 86400 // spec.step
    if weather is None:
        regular = _regular(demand, spec)
        lo = F.lit(0).cast("bigint") if back is None else F.greatest(F.lit(0), F.col("n") - 1 - back)
        table = regular.where(F.col("pos") >= lo).select(
            "series_id", "ts", (F.col("pos") - lo).alias("pos"), (F.col("n") - lo).alias("n"), "value",
            *[F.lit(0.0).alias(m) for m in measures], *keep,
        )
    else:
        near = _merged(demand, weather, spec, measures)
        near = near.where(F.col("value_first_at").isNotNull())
        first, last = F.col("value_first_at"), F.col("value_last_at")
        # greatest() and least() skip NULL: what a series lacks does not bound it.
        begin = F.greatest(first, *[F.col(f"{m}_first_at") for m in measures])
        end = F.least(last, "_weather_last_at")
        inside = (begin <= end) & F.col("_weather_last_at").isNotNull()
        lo = F.when(inside, begin).otherwise(first)
        hi = F.when(inside, end).otherwise(last)
        if back is not None:
            lo = F.greatest(lo, last - back)
        values = {"value": filled_value("value", "linear")}
        for m in measures:
            values[m] = F.when(inside, F.coalesce(filled_value(m, "linear"), F.lit(0.0))).otherwise(0.0)
        table = _grid(near, lo, hi, spec, values)
    table = add_weekend(table, flags).withColumnRenamed("value", "demand")
    table = table.select("series_id", "ts", "demand", "is_weekend", *measures, "pos", "n", *keep)
    return table.withColumns(calendar_columns(F.col("ts"))) if calendar else table


def future_covariates(exog: DataFrame, spec: Spec, steps: int) -> DataFrame:
    """Weekend from the calendar and temperature a year ago, a week ago, or on average.

    Covers the ``steps`` stamps behind ``exog``; temperature is 0.0 if it has none.
    """
    if "temperature_2m" not in exog.columns:
        exog = exog.withColumn("temperature_2m", F.lit(0.0))
    ahead = lag_fallback(exog, "temperature_2m", spec, steps)
    weekend = is_weekend(F.col("ts")).cast("double")
    return ahead.select("series_id", "h", "ts", weekend.alias("is_weekend"), "temperature_2m")
