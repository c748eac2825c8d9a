"""Row selection and per-series gates.

Functions that take a *regular* table use its ``pos`` and ``n`` and need no shuffle.
The others first reduce each series to one row; the join back is left to adaptive
execution, which broadcasts that side only when its measured size is small and
splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import shift
from tidegrid.spec import Spec


def time_slice(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows between two stamps, both included; literal bounds reach the scan."""
    if start is not None:
        df = df.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col("ts") <= F.lit(end).cast("timestamp_ntz"))
    return df


def last_ts(spec: Spec) -> Column:
    """Last stamp of the series a regular row belongs to."""
    return shift("ts", F.col("n") - 1 - F.col("pos"), spec.step)


def recent_days(regular: DataFrame, days: int, spec: Spec) -> DataFrame:
    """Rows within ``days`` of the last stamp of their own series, both ends included."""
    return regular.where(F.col("n") - 1 - F.col("pos") <= days * 86400 // spec.step)


def recent_days_raw(df: DataFrame, days: int) -> DataFrame:
    """The same for a table without grid positions.

    Rows meet their bound by series and day: a long series is many keys, and rows of other days
    find no partner.
    """
    ends = df.groupBy("series_id").agg(F.max("ts").alias("_last"))
    begin = F.col("_last") - F.expr(f"INTERVAL {int(days)} DAYS")
    wanted = ends.select(
        "series_id", begin.alias("_from"), F.explode(F.sequence(F.to_date(begin), F.to_date("_last"))).alias("_day")
    )
    near = df.withColumn("_day", F.to_date("ts")).join(wanted, ["series_id", "_day"])
    return near.where(F.col("ts") >= F.col("_from")).drop("_from", "_day")


def tail_n(regular: DataFrame, rows: int) -> DataFrame:
    """The last ``rows`` rows of each series."""
    return regular.where(F.col("pos") >= F.col("n") - rows)


def chrono_split(df: DataFrame, share: float = 0.8) -> DataFrame:
    """Label the first ``floor(share * n)`` rows of each series as training rows."""
    cut = F.floor(F.lit(share) * F.col("n"))
    return df.withColumn("part", F.when(F.col("pos") < cut, "train").otherwise("test"))


def holdout_split(regular: DataFrame, spec: Spec) -> DataFrame:
    """Label the last validation days of each series."""
    held = F.col("pos") >= F.col("n") - spec.validation_steps
    return regular.withColumn("part", F.when(held, "validation").otherwise("train"))


def training_part(regular: DataFrame, spec: Spec) -> DataFrame:
    """Rows before the validation days, as a regular table of its own."""
    left = F.col("n") - spec.validation_steps
    return regular.where(F.col("pos") < left).withColumn("n", left)


def validation_part(regular: DataFrame, spec: Spec) -> DataFrame:
    return tail_n(regular, spec.validation_steps)


def gates(spec: Spec, lookback: int = 144) -> dict[str, int]:
    """Rows of history each consumer needs."""
    # Margins of the model gates.
    return {
        "seasonal": spec.period,
        "backtest": spec.min_backtest,
        "autoregression": max(10 * spec.period, 500),
        "lookback_features": lookback + 50,
        "calendar_features": lookback + 100,
        "deep_calendar": lookback + 200,
    }


def history_gate(df: DataFrame, needs: dict[str, int]) -> DataFrame:
    """Row count per series and, for every need, whether the series meets it."""
    sizes = df.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.select("series_id", "n", *[(F.col("n") >= v).alias(f"ok_{k}") for k, v in needs.items()])


def empty_series_report(df: DataFrame) -> DataFrame:
    """Series whose rows are all unusable, with their row count."""
    usable = F.col("ts").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")
    sizes = df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(usable).alias("usable")
    )
    return sizes.where("usable = 0").select("series_id", "rows")


def series_profile(df: DataFrame) -> DataFrame:
    """Rows, bounds, extremes, and last value per series."""
    return df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max_by("value", "ts").alias("last_value"),
    )


def common_stamps(left: DataFrame, right: DataFrame) -> DataFrame:
    """Stamps both tables have, per series."""
    return left.select("series_id", "ts").intersect(right.select("series_id", "ts"))
