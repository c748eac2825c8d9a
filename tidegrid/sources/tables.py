"""Readers for measurement tables, stations and weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.calendar import is_weekend
from tidegrid.functions.parsing import DAY_FIRST_FORMATS, nan_to_null, parse_decimal, parse_timestamp


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet by default, CSV with a header when the path says so."""
    if path.rstrip("/").endswith((".csv", ".csv.gz", "_csv")):
        if schema is None:
            raise ValueError("a CSV file needs a schema")
        return spark.read.option("header", True).schema(schema).csv(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _stamp(df: DataFrame, col: str, formats: Sequence[str]) -> Column:
    if isinstance(df.schema[col].dataType, T.StringType):
        return parse_timestamp(F.col(col), formats)
    return F.col(col).cast("timestamp_ntz")


def _measure(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, T.StringType):
        return parse_decimal(F.col(col))
    return nan_to_null(F.col(col).cast("double"))


def typed_wide(
    df: DataFrame,
    time_col: str,
    value_cols: Sequence[str],
    weekend_col: str | None = None,
    formats: Sequence[str] = DAY_FIRST_FORMATS,
) -> DataFrame:
    """``ts``, typed measures and ``is_weekend`` from a wide table; other columns are not read.

    Without a weekend column the flag comes from the calendar.
    """
    picked = df.select(
        _stamp(df, time_col, formats).alias("ts"),
        *[_measure(df, c).alias(c) for c in value_cols],
        *([F.col(weekend_col).cast("boolean").alias("is_weekend")] if weekend_col else []),
    )
    return picked if weekend_col else picked.withColumn("is_weekend", is_weekend(F.col("ts")))


def read_wide(
    spark: SparkSession,
    path: str,
    time_col: str,
    value_cols: Sequence[str],
    weekend_col: str | None = None,
    schema: T.StructType | str | None = None,
    formats: Sequence[str] = DAY_FIRST_FORMATS,
) -> DataFrame:
    """Scan only the time column and the chosen measures of a wide table."""
    return typed_wide(read_table(spark, path, schema), time_col, value_cols, weekend_col, formats)


def wide_to_long(df: DataFrame, value_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per stamp and measure; the column name becomes the series."""
    return df.unpivot(["ts", *keep], list(value_cols), "series_id", "value")


def preview(df: DataFrame, order: Sequence[str], rows: int = 3) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def read_stations(df: DataFrame, name: str, x: str, y: str) -> DataFrame:
    """Station dimension ``station, x, y``. Which axis is the latitude is for the caller to say."""
    return df.select(
        F.trim(name).alias("station"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )


# --- weather ---------------------------------------------------------------------------

# Measures requested from the hourly archive, in request order.
WEATHER_MEASURES = (
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "surface_pressure",
    "wind_speed_10m",
)


def weather_schema(measures: Sequence[str] = WEATHER_MEASURES) -> T.StructType:
    """An hourly response: parallel arrays of stamps and measures."""
    fields = [T.StructField("time", T.ArrayType(T.StringType()))]
    fields += [T.StructField(m, T.ArrayType(T.DoubleType())) for m in measures]
    return T.StructType([T.StructField("hourly", T.StructType(fields))])


def weather_rows(responses: DataFrame, measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    """One row per series and hour from rows ``series_id, body`` (JSON text) or ``series_id, hourly``."""
    if "body" in responses.columns:
        responses = responses.withColumn("hourly", F.from_json("body", weather_schema(measures))["hourly"])
    zipped = F.arrays_zip(F.col("hourly.time").alias("time"), *[F.col(f"hourly.{m}").alias(m) for m in measures])
    rows = responses.select("series_id", F.inline(zipped))
    # Fixed value: stamp layout of the archive.
    ts = F.try_to_timestamp("time", F.lit("yyyy-MM-dd'T'HH:mm")).cast("timestamp_ntz")
    return rows.select("series_id", ts.alias("ts"), *[nan_to_null(F.col(m)).alias(m) for m in measures])


def read_weather(spark: SparkSession, path: str, measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    """Landed responses, one JSON document per line with a ``series_id`` next to ``hourly``."""
    schema = T.StructType([T.StructField("series_id", T.StringType()), *weather_schema(measures).fields])
    return weather_rows(spark.read.schema(schema).json(path), measures)


def weather_requests(
    series: DataFrame,
    stations: DataFrame,
    order: str,
    measures: Sequence[str] = WEATHER_MEASURES,
    timezone: str = "auto",
) -> DataFrame:
    """What a downloader has to fetch per series: date range, coordinates, measures, time zone.

    Stamps of the demand have no zone; ``timezone`` is the one they are local to, or ``auto`` for
    that of the station.
    """
    from tidegrid.operators.align import lookup_stations

    spans = series.groupBy("series_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    named = spans.withColumn("station", F.col("series_id").cast("string"))
    found = lookup_stations(named, stations, order)
    return found.select(
        "series_id",
        F.date_format("lo", "yyyy-MM-dd").alias("start_date"),
        F.date_format("hi", "yyyy-MM-dd").alias("end_date"),
        "x",
        "y",
        F.concat_ws(",", *[F.lit(m) for m in measures]).alias("hourly"),
        F.lit(timezone).alias("timezone"),
    )
