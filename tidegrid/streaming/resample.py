"""The bin mean as a streaming job, for readings that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.spec import Spec


def stream_means(readings: DataFrame, spec: Spec, delay: str = "1 hour") -> DataFrame:
    """Mean per series and bin; a bin is emitted once it is older than ``delay``.

    State is bounded by the bins younger than the watermark. Duplicate stamps are not
    merged first, unlike in the batch job, as that would need one more state per reading.
    """
    stamped = readings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    bins = stamped.groupBy("series_id", F.window("ts", f"{spec.step} seconds"))
    means = bins.agg(F.avg("value").alias("value"))
    return means.select("series_id", F.col("window.start").cast("timestamp_ntz").alias("ts"), "value")
