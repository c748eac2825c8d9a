"""Min-max scaling per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.chunked import dealt


def minmax_fit(df: DataFrame, cols: Sequence[str], train_share: float | None = None) -> DataFrame:
    """Minimum and maximum per series and feature.

    All rows count, or only the first ``train_share`` of each series (needs ``pos``, ``n``). Of a
    table with positions the scaler also has ``n`` and ``n_rows``, the rows it has seen in all.
    """
    counts = F.lit(True) if train_share is None else F.col("pos") < F.floor(F.lit(train_share) * F.col("n"))
    aggs = []
    for c in cols:
        value = F.when(counts, F.col(c))
        aggs += [F.min(value).alias(f"{c}_min"), F.max(value).alias(f"{c}_max")]
    if "pos" in df.columns:
        aggs += [F.max("n").alias("n"), F.count(F.lit(1)).alias("n_rows")]
    return df.groupBy("series_id").agg(*aggs)


def minmax_transform(df: DataFrame, scaler: DataFrame, cols: Sequence[str], span: int = 4096) -> DataFrame:
    """Map every column to 0..1; a constant column maps to 0. Keeps the scaler columns.

    Rows with positions are joined by series and stretch of ``span`` rows: the scaler, one row per
    series, is repeated for every stretch, so that a long series is many keys.
    """
    if "pos" in df.columns and "n" in scaler.columns:
        stretches = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.lit(span)))
        spread = scaler.withColumn("_part", F.explode(stretches)).drop("n", "n_rows")
        joined = df.withColumn("_part", F.floor(F.col("pos") / F.lit(span))).join(dealt(spread), ["series_id", "_part"]).drop("_part")
    else:
        joined = df.join(dealt(scaler.drop("n", "n_rows")), "series_id")
    return joined.withColumns({c: scaled(F.col(c), c) for c in cols})


def scaled(value: Column, feature: str) -> Column:
    """``value`` on the scale of ``feature``, whose scaler columns lie beside it."""
    lo, hi = F.col(f"{feature}_min"), F.col(f"{feature}_max")
    return F.when(hi == lo, F.lit(0.0)).otherwise(F.try_divide(value - lo, hi - lo))


def minmax_inverse(df: DataFrame, col: str, feature: str) -> DataFrame:
    """Undo the scaling of ``col`` with the scaler columns of ``feature``."""
    lo, hi = F.col(f"{feature}_min"), F.col(f"{feature}_max")
    return df.withColumn(col, F.col(col) * (hi - lo) + lo)
