"""From raw readings to complete series on a regular grid.

Raw rows are reduced by partial aggregation on (series, stamp) and (series, bin), so
a series that holds a large share of all readings is spread over the whole cluster.
What follows works on at most one row per bin.

A *regular* table has the columns ``series_id, ts, value, pos, n`` plus ``filled``:
``pos`` counts the grid rows of a series from 0 and ``n`` is their number. Tails,
splits, gates and horizons are then filters on ``pos`` and ``n``, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import slot_of, slot_start
from tidegrid.operators import stretched
from tidegrid.operators.chunked import explode_slots, with_neighbours
from tidegrid.spec import Spec


def drop_missing(df: DataFrame, cols: Sequence[str] = ("ts", "value")) -> DataFrame:
    """Rows with every listed column present; NaN counts as missing."""
    doubles = {f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")}
    for c in cols:
        df = df.where(F.col(c).isNotNull())
        if c in doubles:
            df = df.where(~F.isnan(c))
    return df


def dedup_mean(df: DataFrame, cols: Sequence[str] = ("value",)) -> DataFrame:
    """One row per series and stamp; measures of duplicates are averaged."""
    return df.groupBy("series_id", "ts").agg(*[F.avg(c).alias(c) for c in cols])


def dedup_first(df: DataFrame, flag: str, order: str) -> DataFrame:
    """One row per series and stamp; the flag that came first by ``order`` wins."""
    return df.groupBy("series_id", "ts").agg(F.min_by(flag, order).alias(flag))


def duplicate_stamps(df: DataFrame) -> DataFrame:
    """Stamps that occur more than once, with their counts."""
    counts = df.groupBy("series_id", "ts").agg(F.count(F.lit(1)).alias("copies"))
    return counts.where("copies > 1")


def _slotted(df: DataFrame, spec: Spec) -> DataFrame:
    return df.withColumn("slot", slot_of("ts", spec.step)).groupBy("series_id", "slot")


def _stamped(bins: DataFrame, spec: Spec, cols: Sequence[str]) -> DataFrame:
    return bins.select("series_id", slot_start("slot", spec.step).alias("ts"), *cols)


def slot_means(df: DataFrame, spec: Spec, cols: Sequence[str] = ("value",)) -> DataFrame:
    """Mean per series and slot, for the slots that have rows."""
    return _slotted(df, spec).agg(*[F.avg(c).alias(c) for c in cols])


def slot_firsts(df: DataFrame, flag: str, spec: Spec) -> DataFrame:
    """First flag per series and slot in time order (stamps must be unique)."""
    return _slotted(df, spec).agg(F.min_by(flag, "ts").alias(flag))


def resample_mean(df: DataFrame, spec: Spec, cols: Sequence[str] = ("value",)) -> DataFrame:
    """Mean per series and bin, stamped with the start of the bin."""
    return _stamped(slot_means(df, spec, cols), spec, cols)


def resample_first(df: DataFrame, flag: str, spec: Spec) -> DataFrame:
    """First flag per series and bin, stamped with the start of the bin."""
    return _stamped(slot_firsts(df, flag, spec), spec, [flag])


def regular_grid(df: DataFrame, spec: Spec) -> DataFrame:
    """Every grid stamp from the first to the last bin of each series."""
    slot = slot_of("ts", spec.step)
    ends = df.groupBy("series_id").agg(F.min(slot).alias("lo"), F.max(slot).alias("hi"))
    grid = explode_slots(ends, F.col("lo"), F.col("hi"), spec.chunk, "slot")
    return grid.select("series_id", slot_start("slot", spec.step).alias("ts"))


def fill_grid(
    bins: DataFrame,
    spec: Spec,
    cols: Sequence[str] = ("value",),
    how: str = "linear",
    tail: int | None = None,
) -> DataFrame:
    """Put rows ``(series_id, slot, cols)`` on their full grid and fill the gaps.

    ``linear`` interpolates in time, leaves a leading gap missing and repeats the last
    value behind the last reading; ``ffill`` repeats the last value; ``pad`` does so and
    takes the next value for a leading gap; ``none`` leaves empty bins NULL. Each row produces the grid rows up to the next one, so no grid
    table and no join with it is needed. ``bins`` has one row per series and slot.
    ``tail`` produces only the last rows of each series; ``pos`` and ``n`` still count all.
    """
    near = with_neighbours(bins.select("series_id", "slot", *cols), cols, at="slot", span=spec.chunk)
    stop = F.coalesce(F.col("next_at") - 1, F.col("slot"))
    start = F.col("slot") if tail is None else F.greatest("slot", F.col("last_at") - (tail - 1))
    grid = explode_slots(near, start, stop, spec.chunk, "at")
    filled = [filled_value(c, how).alias(c) for c in cols]
    return grid.select(
        "series_id",
        slot_start("at", spec.step).alias("ts"),
        *filled,
        (F.col("at") - F.col("first_at")).alias("pos"),
        (F.col("last_at") - F.col("first_at") + 1).alias("n"),
        (F.col("at") != F.col("slot")).alias("filled"),
    )


def filled_value(c: str, how: str) -> Column:
    """Value of column ``c`` at slot ``at``, from the neighbours of row ``slot``."""
    prev, prev_at = F.col(f"{c}_prev"), F.col(f"{c}_prev_at")
    if how == "ffill":
        return prev
    if how == "pad":
        return F.coalesce(prev, F.col(f"{c}_next"))
    if how == "none":
        return F.when(F.col("at") == F.col("slot"), F.col(c))
    if how != "linear":
        raise ValueError(f"unknown fill: {how}")
    nxt, next_at = F.col(f"{c}_next"), F.col(f"{c}_next_at")
    share = (F.col("at") - prev_at) / (next_at - prev_at)
    line = prev + (nxt - prev) * share
    return F.when((F.col("at") == prev_at) | next_at.isNull(), prev).otherwise(line)


def clean_bins(raw: DataFrame, spec: Spec) -> DataFrame:
    """Usable readings, duplicates merged, averaged per slot."""
    return slot_means(dedup_mean(drop_missing(raw, ["ts", "value"])), spec)


def regularise(raw: DataFrame, spec: Spec, tail: int | None = None, reach: int | None = None) -> DataFrame:
    """Clean, deduplicate, bin and interpolate ``(series_id, ts, value)`` for every series.

    The first and the last bin of a series hold readings by construction, so edge
    fills have nothing to do and interpolation completes the grid. A consumer that reads
    only the newest rows (baselines, hold-out scores) names their number as ``tail``: the
    long history is then reduced to bins but never expanded to grid rows. One that looks up to
    ``reach`` rows back names that: every row then has these rows beside it, see ``stretched``.
    """
    if reach is None:
        return fill_grid(clean_bins(raw, spec), spec, tail=tail)
    if tail is not None:
        raise ValueError("a table that carries its stretches is whole")
    near = with_neighbours(clean_bins(raw, spec), ["value"], at="slot", span=spec.chunk)
    return stretched.rows_of(stretched.cut(near, spec, reach), spec)


def regularise_flags(raw: DataFrame, spec: Spec, flag: str = "is_weekend", order: str = "ingest_order") -> DataFrame:
    """Flags on the grid of their own rows: first per stamp, first per bin, then carried on."""
    firsts = dedup_first(raw.where(F.col("ts").isNotNull()), flag, order)
    grid = fill_grid(slot_firsts(firsts, flag, spec), spec, [flag], how="pad")
    return grid.select("series_id", "ts", flag)


def ffill(df: DataFrame, cols: Sequence[str], spec: Spec) -> DataFrame:
    """Last non-null value at or before each row."""
    slotted = df.withColumn("_slot", slot_of("ts", spec.step))
    near = with_neighbours(slotted, cols, at="_slot", span=spec.chunk, forward=False)
    return near.select(*[F.col(f"{c}_prev").alias(c) if c in cols else F.col(c) for c in df.columns])


def bfill(df: DataFrame, cols: Sequence[str], spec: Spec) -> DataFrame:
    """First non-null value at or after each row."""
    slotted = df.withColumn("_slot", slot_of("ts", spec.step))
    near = with_neighbours(slotted, cols, at="_slot", span=spec.chunk)
    return near.select(
        *[F.coalesce(c, f"{c}_next").alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def interpolate_rows(df: DataFrame, cols: Sequence[str], spec: Spec) -> DataFrame:
    """Fill NULLs of existing grid rows: linear inside, nearest value at both edges."""
    slotted = df.withColumn("_slot", slot_of("ts", spec.step))
    near = with_neighbours(slotted, cols, at="_slot", span=spec.chunk)

    def filled(c: str) -> Column:
        prev, nxt = F.col(f"{c}_prev"), F.col(f"{c}_next")
        share = (F.col("_slot") - F.col(f"{c}_prev_at")) / (F.col(f"{c}_next_at") - F.col(f"{c}_prev_at"))
        return F.coalesce(F.col(c), prev + (nxt - prev) * share, prev, nxt).alias(c)

    return near.select(*[filled(c) if c in cols else F.col(c) for c in df.columns])


def constant_fill(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Replace NULL by a constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def fill_stats(regular: DataFrame) -> DataFrame:
    """Grid points and filled bins per series."""
    return regular.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("points"), F.count_if("filled").alias("filled")
    )


def grid_step_check(df: DataFrame, spec: Spec) -> DataFrame:
    """Smallest and largest distance between consecutive stamps, in seconds."""
    secs = df.select("series_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    near = with_neighbours(secs, [], at="at", span=spec.step * spec.chunk)
    gap = F.col("next_at") - F.col("at")
    return near.groupBy("series_id").agg(F.min(gap).alias("min_step"), F.max(gap).alias("max_step"))
