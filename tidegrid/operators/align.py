"""Stations, weather alignment and as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import shift, slot_of
from tidegrid.operators.chunked import with_neighbours
from tidegrid.operators.regularise import fill_grid, interpolate_rows
from tidegrid.spec import Spec


def first_station(stations: DataFrame, order: str) -> DataFrame:
    """One row per station name: the one that comes first by ``order``, of equal ones by the other columns."""
    rest = [c for c in stations.columns if c not in ("station", order)]
    first = stations.groupBy("station").agg(F.min(F.struct(order, *rest)).alias("_first"))
    return first.select("station", *[F.col(f"_first.{c}") for c in rest])


def lookup_stations(names: DataFrame, stations: DataFrame, order: str) -> DataFrame:
    """Station columns for every requested name that is known."""
    wanted = names.withColumn("station", F.trim("station"))
    return wanted.join(first_station(stations, order), "station")


def known_stations(names: DataFrame, stations: DataFrame) -> DataFrame:
    wanted = names.select(F.trim("station").alias("station"))
    return wanted.join(stations.select("station"), "station", "left_semi")


def unknown_stations(names: DataFrame, stations: DataFrame) -> DataFrame:
    wanted = names.select(F.trim("station").alias("station"))
    return wanted.join(stations.select("station"), "station", "left_anti")


def upsample(weather: DataFrame, spec: Spec, cols: Sequence[str]) -> DataFrame:
    """Weather on the demand grid, linear between its stamps.

    Ends at the last weather stamp; the rest of that hour has no rows.
    """
    slotted = weather.select("series_id", slot_of("ts", spec.step).alias("slot"), *cols)
    return fill_grid(slotted, spec, cols).select("series_id", "ts", *cols)


def align_inner(demand: DataFrame, weather: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Demand rows that have a weather row."""
    return demand.join(weather.select("series_id", "ts", *cols), ["series_id", "ts"])


def align_left_fill(demand: DataFrame, weather: DataFrame, cols: Sequence[str], spec: Spec) -> DataFrame:
    """All demand rows; missing weather is interpolated, then padded at both edges."""
    joined = demand.join(weather.select("series_id", "ts", *cols), ["series_id", "ts"], "left")
    return interpolate_rows(joined, cols, spec)


def asof_lookup(probes: DataFrame, values: DataFrame, col: str, spec: Spec) -> DataFrame:
    """Last non-missing ``col`` at or before each probe, NULL when there is none.

    ``values`` lie on the grid, one row per series and stamp; probes may lie anywhere and
    repeat. All probes of a slot see the same value, so the distinct slots are looked up
    in one time-chunked window together with the values, and joined back by equality.
    However many probes hit one slot, a window partition holds at most two rows per slot.
    """
    asked = probes.withColumn("_slot", slot_of("ts", spec.step))
    known = values.where(F.col(col).isNotNull()).select(
        "series_id", slot_of("ts", spec.step).alias("_slot"), F.lit(0).alias("_kind"), col
    )
    empty = F.lit(None).cast(values.schema[col].dataType).alias(col)
    slots = asked.select("series_id", "_slot").distinct().select("*", F.lit(1).alias("_kind"), empty)
    near = with_neighbours(
        known.unionByName(slots), [col], at="_slot", span=spec.chunk, tie=["_kind"], forward=False
    )
    found = near.where("_kind = 1").select("series_id", "_slot", F.col(f"{col}_prev").alias(col))
    return asked.join(found, ["series_id", "_slot"], "left").drop("_slot")


def asof_fallback(
    future: DataFrame, values: DataFrame, col: str, spec: Spec, lags_days: Sequence[int] = (365, 7)
) -> DataFrame:
    """Value ``lags_days`` earlier, the first lag that has one; else the mean of the series.

    All lags are probed in one pass. ``future`` needs unique ``(series_id, ts)``.
    """
    lagged = F.array(
        *[
            F.struct(F.lit(i).alias("lag"), (F.col("ts") - F.expr(f"INTERVAL {int(d)} DAYS")).alias("ts"))
            for i, d in enumerate(lags_days)
        ]
    )
    probes = future.select("series_id", F.col("ts").alias("target"), F.explode(lagged).alias("probe"))
    probes = probes.select("series_id", "target", "probe.lag", "probe.ts")
    found = asof_lookup(probes, values, col, spec).groupBy("series_id", "target").agg(
        F.min_by(col, F.when(F.col(col).isNotNull(), F.col("lag"))).alias(col)
    )
    means = values.groupBy("series_id").agg(F.avg(col).alias("_mean"))
    return (
        found.join(means, "series_id", "left")
        .select("series_id", F.col("target").alias("ts"), F.coalesce(col, "_mean").alias(col))
    )


def lag_fallback(
    table: DataFrame, col: str, spec: Spec, steps: int, lags_days: Sequence[int] = (365, 7)
) -> DataFrame:
    """``asof_fallback`` for the steps behind a gapless table with ``pos`` and ``n``.

    Without gaps the value at or before a stamp is found by position. Each row knows the
    future steps it serves, so the history is filtered and exploded, never shuffled. A
    lag that reaches behind the end of the series gives the last value.
    """
    lags = [d * 86400 // spec.step for d in lags_days]
    last = F.col("n") - 1
    horizon = F.sequence(F.lit(1).cast("bigint"), F.lit(steps).cast("bigint"))

    def reachable(h: Column, lag: int) -> Column:
        return last + h - F.lit(lag) >= 0

    def chosen(h: Column, k: int) -> Column:
        """The first lag that reaches into the series is lag number k."""
        hit = reachable(h, lags[k])
        for lag in lags[:k]:
            hit = hit & ~reachable(h, lag)
        return hit

    none = F.array().cast("array<bigint>")
    parts = []
    for k, lag in enumerate(lags):
        h = F.col("pos") - last + F.lit(lag)
        parts.append(F.when(h.between(1, steps) & chosen(h, k), F.array(h)).otherwise(none))

    def beyond(h: Column) -> Column:
        hits = [chosen(h, k) & (h > lag) for k, lag in enumerate(lags)]
        out = F.lit(False)
        for hit in hits:
            out = out | hit
        return out

    def unreached(h: Column) -> Column:
        out = F.lit(True)
        for lag in lags:
            out = out & ~reachable(h, lag)
        return out

    at_end = F.col("pos") == last
    parts.append(F.when(at_end, F.filter(horizon, beyond)).otherwise(none))
    meanwhile = F.when(at_end, F.filter(horizon, unreached)).otherwise(none)
    served = F.concat(
        F.transform(F.concat(*parts), lambda h: F.struct(h.alias("h"), F.lit(False).alias("mean"))),
        F.transform(meanwhile, lambda h: F.struct(h.alias("h"), F.lit(True).alias("mean"))),
    )
    rows = table.select("series_id", "ts", "pos", "n", col, F.explode(served).alias("s"))
    means = table.groupBy("series_id").agg(F.avg(col).alias("_mean"))
    return rows.join(means, "series_id").select(
        "series_id",
        F.col("s.h").cast("int").alias("h"),
        shift("ts", last - F.col("pos") + F.col("s.h"), spec.step).alias("ts"),
        F.when(F.col("s.mean"), F.col("_mean")).otherwise(F.col(col)).alias(col),
    )


def weekly_cycle(covariates: DataFrame, cols: Sequence[str], spec: Spec, steps: int) -> DataFrame:
    """Future covariates that repeat the last seven days.

    Future row i takes the row seven days of steps before it in the cycle, or the last row where the
    history is too short. Every history row knows the future rows it serves, so this
    is an explode of the tail, not a join. ``covariates`` needs ``pos`` and ``n``.
    """
    week = 7 * spec.period
    offset = F.col("pos") - (F.col("n") - week)
    own = F.when(offset.between(0, steps - 1), F.sequence(offset, F.lit(steps - 1).cast("bigint"), F.lit(week).cast("bigint")))
    short = F.filter(
        F.sequence(F.lit(0).cast("bigint"), F.lit(steps - 1).cast("bigint")),
        lambda i: F.pmod(i, F.lit(week)) < F.lit(week) - F.col("n"),
    )
    extra = F.when((F.col("pos") == F.col("n") - 1) & (F.col("n") < week), short)
    none = F.array().cast("array<bigint>")
    served = F.concat(F.coalesce(own, none), F.coalesce(extra, none))
    tail = covariates.where(offset >= 0)
    return tail.withColumn("_i", F.explode(served)).select(
        "series_id",
        (F.col("_i") + 1).cast("int").alias("h"),
        shift("ts", F.col("n") - F.col("pos") + F.col("_i"), spec.step).alias("ts"),
        *cols,
    )
