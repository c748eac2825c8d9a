"""Lookback sequences, multi-step targets and seasonal lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.operators import stretched
from tidegrid.operators.chunked import with_halo
from tidegrid.spec import Spec


def lookback_windows(
    df: DataFrame, features: Sequence[str], target: str, lookback: int, spec: Spec, cap: int | None = None
) -> DataFrame:
    """One sample per row that has ``lookback`` rows before it.

    ``window`` holds those rows oldest first, ``target`` is the value of the row itself.
    ``cap`` keeps only the newest samples of a series; rows that no kept sample needs
    are cut off before the arrays are built.
    """
    first = F.lit(lookback)
    if cap is not None:
        first = F.greatest(first, F.col("n") - cap)
        df = df.where(F.col("pos") >= F.greatest(F.lit(0), F.col("n") - cap - lookback))
    row = F.struct(*[F.col(c).cast("double").alias(c) for c in features])
    rows = df.select("series_id", "ts", "pos", "n", row.alias("_row"), F.col(target).alias("target"))
    framed = with_halo(
        rows,
        lookback,
        0,
        {"window": lambda w: F.collect_list("_row").over(w.rowsBetween(-lookback, -1))},
        span=spec.chunk,
    )
    return framed.where(F.col("pos") >= first).drop("_row")


def horizon_targets(df: DataFrame, col: str, steps: int, spec: Spec) -> DataFrame:
    """The next ``steps`` values from each row on, for every row that has them all."""
    rows = df.select("series_id", "ts", "pos", "n", col)
    framed = with_halo(
        rows,
        0,
        steps - 1,
        {"targets": lambda w: F.collect_list(col).over(w.rowsBetween(0, steps - 1))},
        span=spec.chunk,
    )
    return framed.where(F.size("targets") == steps).drop(col)


def lagged(df: DataFrame, col: str, lags: Sequence[int], spec: Spec) -> DataFrame:
    """Add ``<col>_lag<k>`` for every k; NULL where the series has no such row.

    The lagged ``value`` of a table that carries its stretches lies in the row, others need a window.
    """
    if col == "value" and stretched.reaches(df, max(lags)):
        return df.withColumns({f"{col}_lag{k}": stretched.back(k) for k in lags}).drop(*stretched.COLUMNS)

    def lag(k: int):
        return lambda w: F.lag(col, k).over(w)

    return with_halo(df.drop(*stretched.COLUMNS), max(lags), 0, {f"{col}_lag{k}": lag(k) for k in lags}, span=spec.chunk)


def seasonal_lags(regular: DataFrame, spec: Spec) -> DataFrame:
    """Predictors for the last validation days from the same slot of earlier days.

    Lags look only inside the validation days, so the first of them has no prediction:
    ``lag_value`` is the day before, ``lag_mean`` the mean of all earlier days there.
    A window partition is one slot of one series and holds ``validation_days`` rows.
    """
    tail = regular.where(F.col("pos") >= F.col("n") - spec.validation_steps)
    offset = F.col("pos") - F.greatest(F.col("n") - spec.validation_steps, F.lit(0))
    slot = tail.withColumn("_slot", F.pmod(offset, F.lit(spec.period)))
    w = W.partitionBy("series_id", "_slot").orderBy("pos")
    return slot.select(
        "series_id",
        "ts",
        "value",
        "n",
        F.lag("value").over(w).alias("lag_value"),
        F.avg("value").over(w.rowsBetween(-spec.validation_days, -1)).alias("lag_mean"),
    )


def step_pairs(regular: DataFrame, spec: Spec) -> DataFrame:
    """Every row with the value of the row before it (NULL for the first)."""
    return lagged(regular.select("series_id", "ts", "value", "pos", "n", *stretched.columns(regular)), "value", [1], spec)


def window_digest(window: Column, field: str) -> dict[str, Column]:
    """Size, ends and sum of one field of a lookback window."""
    values = F.transform(window, lambda r: r[field])
    return {
        "size": F.size(window).cast("bigint"),
        "oldest": values[0],
        "newest": F.element_at(values, -1),
        "total": F.aggregate(values, F.lit(0.0), lambda a, v: a + v),
    }
