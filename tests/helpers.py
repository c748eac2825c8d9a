from datetime import datetime, timedelta

from pyspark.sql import functions as F

START = datetime(2024, 1, 1)


def stamp(minutes):
    return START + timedelta(minutes=minutes)


def series(spark, rows, extra=""):
    """Rows ``(series_id, minutes after the start, value)``."""
    data = [(s, stamp(m) if m is not None else None, v) for s, m, v in rows]
    return spark.createDataFrame(data, "series_id string, ts timestamp_ntz, value double")


def regular(spark, values, step_minutes=30, series_id="a"):
    """A regular table of one series."""
    n = len(values)
    data = [(series_id, stamp(step_minutes * i), float(v), i, n) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "series_id string, ts timestamp_ntz, value double, pos bigint, n bigint")


def column(df, name, order="ts"):
    return [r[0] for r in df.orderBy(F.col(order)).select(name).collect()]
