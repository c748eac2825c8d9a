"""Registered queries: every operator on the shared test tables.

A query takes a session and the folder of the tables and returns a DataFrame. All of
them read whole tables, so their work grows with the data. Floating results are
rounded (six decimals, three for prices) for comparison with another engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions import calendar as cal
from tidegrid.functions.parsing import parse_decimal, parse_timestamp, safe_name
from tidegrid.functions.timegrid import ceil_to_step, floor_to_step
from tidegrid.operators import (
    align, analogue, appended, arma, asof, baseline, basis, boosted, evaluate, features, gaps, regularise, regression, scaling, select, stacked, stretched,
    unitroot, windows,
)
from tidegrid.plans import comparison
from tidegrid.session import configure, saved, shared_folder
from tidegrid.sources import sinks, tables
from tidegrid.spec import DAILY, HALF_HOURLY, HOURLY, Spec
from tidegrid.streaming import fill

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HALF = HALF_HOURLY
MONTHLY = Spec(step=86400, period=30, horizon=14, k_days=1, validation_days=1)
MEASURES = tables.WEATHER_MEASURES
FEATURES = ("demand", "is_weekend", "temperature_2m")


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; a trailing underscore keeps imported names free."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles for comparison with another engine.

    Means and interpolated values are often exact ties (…0625), which engines break by the last
    bit of a sum. A nudge of a thousandth of the last digit takes them off the tie.
    """
    nudge = 10.0 ** -(digits + 3)
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(F.col(c) + nudge, digits) for c in doubles})


# --- inputs ------------------------------------------------------------------------


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular readings, one series per event type."""
    return load(spark, sf_dir, "events").select(F.col("event_type").alias("series_id"), "ts", "value")


def user_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular readings, one series per user."""
    return load(spark, sf_dir, "events").select(F.col("user_id").alias("series_id"), "ts", "value")


def minute_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with stamps cut to the minute: some are on the grid, some repeat."""
    return readings(spark, sf_dir).withColumn("ts", F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz"))


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as a spreadsheet has them: day-first stamps, decimal commas, bad cells."""
    stamp = F.when(F.col("value") > 200, F.lit("unknown")).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    number = F.when(F.col("value") < 1, F.lit("n/a")).otherwise(
        F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    )
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("series_id"),
        stamp.alias("stamp"),
        number.alias("number"),
        (F.col("value") > 20).alias("is_weekend"),
    )


def parsed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_readings(spark, sf_dir).select(
        "event_id",
        "series_id",
        parse_timestamp(F.col("stamp")).alias("ts"),
        parse_decimal(F.col("number")).alias("value"),
        "is_weekend",
    )


def price_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many readings per day over several years, one series per order priority."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
        F.col("o_totalprice").alias("value"),
    )


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly measures per event type, with hours missing."""
    events = load(spark, sf_dir, "events")
    hour = floor_to_step("ts", 3600)
    k = F.get_json_object("props", "$.k").cast("double")
    return events.groupBy(F.col("event_type").alias("series_id"), hour.alias("ts")).agg(
        F.avg("value").alias("temperature_2m"),
        F.avg(k).alias("relative_humidity_2m"),
        F.min("value").alias("precipitation"),
        F.max("value").alias("surface_pressure"),
        F.count(F.lit(1)).cast("double").alias("wind_speed_10m"),
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON response per series and day, at most 24 stamps each."""
    rows = hourly_weather(spark, sf_dir).withColumn("time", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    days = rows.groupBy("series_id", F.to_date("ts").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct("time", *MEASURES))).alias("rows")
    )
    arrays = [F.col(f"rows.{c}").alias(c) for c in ("time", *MEASURES)]
    return days.select("series_id", F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("body"))


def half_regular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise.regularise(readings(spark, sf_dir), HALF)


def half_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise.regularise(readings(spark, sf_dir), HALF, tail=evaluate.baseline_tail(HALF))


def user_regular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise.regularise(user_readings(spark, sf_dir), HOURLY)


def user_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise.regularise(user_readings(spark, sf_dir), HOURLY, tail=evaluate.baseline_tail(HOURLY))


def user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise.regularise(user_readings(spark, sf_dir), DAILY)


def user_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly tables of every user: one of the whole history and one of each week, so long and short ones."""
    users = user_readings(spark, sf_dir)
    week = F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")
    names = F.array(F.lit("all"), week)
    rows = users.select(F.col("series_id").cast("string").alias("user"), "ts", "value", F.explode(names).alias("part"))
    named = rows.select(F.concat_ws("/", "user", "part").alias("series_id"), "ts", "value")
    return regularise.regularise(named, HOURLY, reach=7 * HOURLY.period)


def price_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise.regularise(price_readings(spark, sf_dir), DAILY)


def half_weather(spark: SparkSession, sf_dir: str, cols: Sequence[str] = ("temperature_2m",)) -> DataFrame:
    return align.upsample(hourly_weather(spark, sf_dir), HALF, cols)


def half_features(spark: SparkSession, sf_dir: str, days: int | None = None) -> DataFrame:
    return features.feature_matrix(readings(spark, sf_dir), hourly_weather(spark, sf_dir), HALF, days=days)


def half_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.covariates(readings(spark, sf_dir), hourly_weather(spark, sf_dir), HALF)


def half_exog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.exog_matrix(readings(spark, sf_dir), hourly_weather(spark, sf_dir), HALF)


def sparse_weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand rows with the hourly temperature where there is one."""
    weather = hourly_weather(spark, sf_dir).select("series_id", "ts", "temperature_2m")
    demand = half_regular(spark, sf_dir).select("series_id", "ts")
    return demand.join(weather, ["series_id", "ts"], "left")


def two_baselines(regular: DataFrame, spec: Spec) -> DataFrame:
    models = evaluate.baseline_models(spec).values()
    first, second = [make(regular, spec, spec.horizon) for make in models]
    return first.unionByName(second)


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = load(spark, sf_dir, "supplier")
    return tables.read_stations(supplier, "s_name", "s_nationkey", "s_acctbal")


def requested_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with stray blanks, most of them unknown."""
    name = F.concat(F.lit("  Supplier#"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lit(" "))
    return load(spark, sf_dir, "lineitem").select(name.alias("station")).distinct()


# --- sources and sinks ---------------------------------------------------------------


@query
def read_wide_table(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    wide = tables.read_wide(spark, f"{sf_dir}/lineitem.parquet", "l_shipdate", cols)
    return rounded(wide.groupBy("ts", "is_weekend").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols]))


@query
def station_dim(spark, sf_dir):
    return supplier_stations(spark, sf_dir)


@query
def weather_json_rows(spark, sf_dir):
    return rounded(tables.weather_rows(weather_documents(spark, sf_dir)))


@query
def weather_requests(spark, sf_dir):
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    series = load(spark, sf_dir, "lineitem").select(name.alias("series_id"), F.col("l_shipdate").alias("ts"))
    supplier = load(spark, sf_dir, "supplier")
    stations = supplier.select(
        F.trim("s_name").alias("station"), F.col("s_nationkey").cast("double").alias("x"),
        F.col("s_acctbal").cast("double").alias("y"), "s_suppkey",
    )
    return tables.weather_requests(series, stations, "s_suppkey")


@query
def preview_rows(spark, sf_dir):
    return tables.preview(load(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"), ["ts", "event_id"])


@query
def forecast_output_table(spark, sf_dir):
    regular = half_regular(spark, sf_dir)
    weather = half_weather(spark, sf_dir, ("temperature_2m", "relative_humidity_2m"))
    table = sinks.forecast_table(
        regular, two_baselines(regular, HALF), ["seasonal_naive", "kday_average"],
        weather, ["temperature_2m", "relative_humidity_2m"],
    )
    return rounded(table)


@query
def metrics_report_lines(spark, sf_dir):
    models = evaluate.baseline_models(HALF)
    scores = evaluate.backtest_holdout(half_newest(spark, sf_dir), models, HALF)
    return sinks.report_lines(evaluate.compare_models(scores, list(models)), list(models))


@query
def safe_name_(spark, sf_dir):
    raw = F.concat_ws("/", "o_orderpriority", "o_orderstatus", F.concat_ws("\\", "o_custkey", "o_orderkey"))
    return load(spark, sf_dir, "orders").select("o_orderkey", safe_name(raw).alias("name"))


# --- projections and filters ---------------------------------------------------------


@query
def wide_to_long(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    wide = tables.read_wide(spark, f"{sf_dir}/lineitem.parquet", "l_shipdate", cols)
    return tables.wide_to_long(wide, cols)


@query
def drop_missing(spark, sf_dir):
    return regularise.drop_missing(parsed_readings(spark, sf_dir)).select("event_id", "series_id", "ts", "value")


@query
def known_stations(spark, sf_dir):
    return align.known_stations(requested_names(spark, sf_dir), supplier_stations(spark, sf_dir))


@query
def unknown_stations(spark, sf_dir):
    return align.unknown_stations(requested_names(spark, sf_dir), supplier_stations(spark, sf_dir))


@query
def station_lookup(spark, sf_dir):
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = load(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    stations = supplier.select(
        F.col("n_name").alias("station"), F.col("s_acctbal").alias("x"), F.col("s_nationkey").cast("double").alias("y"), "s_suppkey"
    )
    customers = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    names = customers.select("c_custkey", F.col("n_name").alias("station"))
    return align.lookup_stations(names, stations, "s_suppkey")


@query
def time_slice(spark, sf_dir):
    return select.time_slice(readings(spark, sf_dir), "2024-01-08 00:00:00", "2024-01-15 12:00:00")


@query
def recent_days(spark, sf_dir):
    recent = select.recent_days(price_daily(spark, sf_dir), 120, DAILY)
    return rounded(recent.select("series_id", "ts", "value"), 3)


@query
def recent_days_raw(spark, sf_dir):
    return select.recent_days_raw(user_readings(spark, sf_dir), 7)


@query
def tail_n(spark, sf_dir):
    tail = select.tail_n(half_newest(spark, sf_dir), 14 * HALF.period)
    return rounded(tail.select("series_id", "ts", "value"))


@query
def history_gate(spark, sf_dir):
    return select.history_gate(user_regular(spark, sf_dir), select.gates(HOURLY, 21 * HOURLY.period))


@query
def empty_series_report(spark, sf_dir):
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    raw = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("series_id"), F.col("o_orderdate").alias("ts"), closed.alias("value")
    )
    return select.empty_series_report(raw)


# --- scalar functions -------------------------------------------------------------------


@query
def parse_timestamp_(spark, sf_dir):
    text = (
        F.when(F.col("value") > 200, F.lit("unknown"))
        .when(F.col("event_type") == "click", F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
        .when(F.col("event_type") == "view", F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    )
    return load(spark, sf_dir, "events").select("event_id", parse_timestamp(text).alias("parsed"))


@query
def parse_decimal_comma(spark, sf_dir):
    return text_readings(spark, sf_dir).select("event_id", parse_decimal(F.col("number")).alias("parsed"))


@query
def grid_floor_ceil(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        "event_id", floor_to_step("ts", HALF.step).alias("floor_ts"), ceil_to_step("ts", HALF.step).alias("ceil_ts")
    )


@query
def calendar_features(spark, sf_dir):
    ts = F.col("ts")
    return rounded(
        load(spark, sf_dir, "events").select(
            "event_id",
            cal.hour_of_day(ts).alias("hour_of_day"),
            cal.day_of_week(ts).alias("day_of_week"),
            cal.day_of_year(ts).alias("day_of_year"),
        )
    )


@query
def cyclical_features(spark, sf_dir):
    columns = cal.calendar_columns(F.col("ts"))
    wanted = ("hour_sin", "hour_cos", "day_sin", "day_cos")
    return rounded(load(spark, sf_dir, "events").select("event_id", *[columns[c].alias(c) for c in wanted]))


@query
def weekend_flag(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", cal.is_weekend(F.col("o_orderdate")).alias("is_weekend"))


# --- regularisation -----------------------------------------------------------------------


@query
def dedup_mean(spark, sf_dir):
    return rounded(regularise.dedup_mean(price_readings(spark, sf_dir)), 3)


@query
def dedup_first(spark, sf_dir):
    flags = load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        F.col("o_orderdate").alias("ts"),
        (F.col("o_orderstatus") == "F").alias("flag"),
        "o_orderkey",
    )
    return regularise.dedup_first(flags, "flag", "o_orderkey")


@query
def duplicate_stamps(spark, sf_dir):
    return regularise.duplicate_stamps(price_readings(spark, sf_dir))


@query
def resample_mean(spark, sf_dir):
    return rounded(regularise.resample_mean(readings(spark, sf_dir), HALF))


@query
def resample_first(spark, sf_dir):
    flags = readings(spark, sf_dir).withColumn("flag", F.col("value") > 50)
    return regularise.resample_first(flags, "flag", HALF)


@query
def regular_grid(spark, sf_dir):
    return regularise.regular_grid(readings(spark, sf_dir), HALF)


@query
def interpolate_time(spark, sf_dir):
    return rounded(half_regular(spark, sf_dir))


@query
def interpolate_linear_fill(spark, sf_dir):
    return rounded(regularise.interpolate_rows(sparse_weather_rows(spark, sf_dir), ["temperature_2m"], HALF))


@query
def ffill(spark, sf_dir):
    return rounded(regularise.ffill(sparse_weather_rows(spark, sf_dir), ["temperature_2m"], HALF))


@query
def bfill(spark, sf_dir):
    return rounded(regularise.bfill(sparse_weather_rows(spark, sf_dir), ["temperature_2m"], HALF))


@query
def constant_fill(spark, sf_dir):
    return rounded(regularise.constant_fill(sparse_weather_rows(spark, sf_dir), {"temperature_2m": 0.0}))


@query
def upsample_linear(spark, sf_dir):
    return rounded(half_weather(spark, sf_dir, MEASURES))


@query
def fill_stats(spark, sf_dir):
    return regularise.fill_stats(half_regular(spark, sf_dir))


@query
def grid_step_check(spark, sf_dir):
    return regularise.grid_step_check(half_regular(spark, sf_dir), HALF)


@query
def missing_slots(spark, sf_dir):
    return gaps.missing_slots(minute_readings(spark, sf_dir), HALF)


@query
def missing_slots_binned(spark, sf_dir):
    return gaps.missing_slots(readings(spark, sf_dir), HALF, mode="bin")


@query
def missing_blocks(spark, sf_dir):
    return gaps.missing_blocks(minute_readings(spark, sf_dir), HALF)


@query
def top_missing_blocks(spark, sf_dir):
    return gaps.top_missing_blocks(minute_readings(spark, sf_dir), HALF)


@query
def regularise_(spark, sf_dir):
    """Text cells to a regular table with its flag, end to end."""
    return rounded(features.regularise_with_flags(parsed_readings(spark, sf_dir), HALF, order="event_id"))


@query
def regular_appended(spark, sf_dir):
    """The hourly table of every user, kept on disk and grown by three batches, the last one late readings."""
    spec = Spec(step=3600, period=24, horizon=48, chunk=168)
    raw = user_readings(spark, sf_dir)
    ends = raw.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    late = F.pmod(F.xxhash64("series_id", "ts"), F.lit(10)) == 0
    batch = F.when(late, 2).when(F.col("ts") < F.lit(ends.lo + (ends.hi - ends.lo) / 2), 0).otherwise(1)
    path = f"{shared_folder(spark)}/regular-{uuid.uuid4().hex}"
    for k in range(3):
        appended.append(raw.where(batch == k), spec, path, str(k))
    return rounded(appended.regular_rows(spark, path, spec))


@query
def stream_regular_users(spark, sf_dir):
    """The hourly table of every user from the event files as a stream: what is final an hour after the last stamp."""
    path = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")  # a pattern may name one file
    rows = fill.stream_regular(events.select(F.col("user_id").alias("series_id"), "ts", "value"), HOURLY)
    store = spark.conf.get(fill.STORE[0], None)
    spark.conf.set(*fill.STORE)
    try:
        sink = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/log")
        sink.trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    finally:
        spark.conf.unset(fill.STORE[0]) if store is None else spark.conf.set(fill.STORE[0], store)
    return rounded(spark.read.schema(rows.schema).parquet(f"{path}/rows"))


@query
def regularise_users(spark, sf_dir):
    """Many short series at once."""
    return rounded(user_regular(spark, sf_dir).select("series_id", "ts", "value"))


# --- joins ---------------------------------------------------------------------------------


@query
def align_inner(spark, sf_dir):
    demand = half_regular(spark, sf_dir).select("series_id", "ts", "value")
    return rounded(align.align_inner(demand, half_weather(spark, sf_dir), ["temperature_2m"]))


@query
def align_left_fill(spark, sf_dir):
    """Upsampled temperature joined to all demand rows, then interpolated and padded."""
    demand = half_regular(spark, sf_dir).select("series_id", "ts")
    table = align.align_left_fill(demand, half_weather(spark, sf_dir), ["temperature_2m"], HALF)
    return rounded(features.add_weekend(table).select("series_id", "ts", "is_weekend", "temperature_2m"))


@query
def covariates(spark, sf_dir):
    """The same table from demand and weather filled in one pass."""
    return rounded(half_covariates(spark, sf_dir).select("series_id", "ts", "is_weekend", "temperature_2m"))


@query
def feature_matrix(spark, sf_dir):
    """The newest 90 days of every series."""
    return rounded(half_features(spark, sf_dir, days=90))


@query
def feature_matrix_calendar(spark, sf_dir):
    measures = ("temperature_2m", "relative_humidity_2m")
    return rounded(
        features.feature_matrix(
            readings(spark, sf_dir), hourly_weather(spark, sf_dir), HALF, days=120, measures=measures, calendar=True
        )
    )


@query
def exog_matrix(spark, sf_dir):
    return rounded(half_exog(spark, sf_dir))


@query
def feature_matrix_some_weather(spark, sf_dir):
    """One series has no weather: it keeps its rows, with zeros."""
    weather = hourly_weather(spark, sf_dir).where("series_id <> 'click'")
    return rounded(features.feature_matrix(readings(spark, sf_dir), weather, HALF))


@query
def exog_matrix_some_weather(spark, sf_dir):
    """One series has no weather: its temperature is missing."""
    weather = hourly_weather(spark, sf_dir).where("series_id <> 'click'")
    return rounded(features.exog_matrix(readings(spark, sf_dir), weather, HALF))


@query
def asof_lookup(spark, sf_dir):
    probes = load(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("series_id"), (F.col("ts") - F.expr("INTERVAL 7 DAYS")).alias("ts"))
    return rounded(align.asof_lookup(probes, hourly_weather(spark, sf_dir), "temperature_2m", HOURLY))


@query
def asof_fallback(spark, sf_dir):
    regular = price_daily(spark, sf_dir)
    ahead = baseline.future_index(regular, DAILY, DAILY.horizon).select("series_id", "ts")
    return rounded(align.asof_fallback(ahead, regular, "value", DAILY), 3)


@query
def future_covariates(spark, sf_dir):
    return rounded(features.future_covariates(half_exog(spark, sf_dir), HALF, HALF.horizon))


@query
def future_by_lag(spark, sf_dir):
    """A year ago, a week ago or the mean, found by position in a gapless table."""
    return rounded(align.lag_fallback(price_daily(spark, sf_dir), "value", DAILY, DAILY.horizon), 3)


@query
def future_by_lag_users(spark, sf_dir):
    """Series of a month: lags behind their start fall through to the next lag and the mean."""
    return rounded(align.lag_fallback(user_daily(spark, sf_dir), "value", DAILY, DAILY.horizon, lags_days=(28, 7)))


@query
def weekly_cycle_covariates(spark, sf_dir):
    table = half_covariates(spark, sf_dir)
    return rounded(align.weekly_cycle(table, ["is_weekend", "temperature_2m"], HALF, HALF.validation_steps + HALF.horizon))


@query
def history_plus_future(spark, sf_dir):
    cols = ["is_weekend", "temperature_2m"]
    table = half_covariates(spark, sf_dir)
    ahead = align.weekly_cycle(table, cols, HALF, HALF.horizon)
    return rounded(table.select("series_id", "ts", *cols).unionByName(ahead.select("series_id", "ts", *cols)))


@query
def common_stamps(spark, sf_dir):
    return select.common_stamps(half_regular(spark, sf_dir), half_weather(spark, sf_dir))


# --- aggregates and windows -----------------------------------------------------------------


@query
def slot_means(spark, sf_dir):
    return rounded(baseline.slot_averages(half_newest(spark, sf_dir), HALF, HALF.k_days))


@query
def series_profile(spark, sf_dir):
    return rounded(select.series_profile(user_regular(spark, sf_dir)))


@query
def forecast_summary(spark, sf_dir):
    return rounded(evaluate.forecast_summary(two_baselines(user_newest(spark, sf_dir), HOURLY)))


@query
def seasonal_lag(spark, sf_dir):
    lags = windows.seasonal_lags(half_newest(spark, sf_dir), HALF)
    return rounded(lags.select("series_id", "ts", "value", "lag_value"))


@query
def seasonal_lag_mean(spark, sf_dir):
    lags = windows.seasonal_lags(half_newest(spark, sf_dir), HALF)
    return rounded(lags.select("series_id", "ts", "value", "lag_mean"))


@query
def lookback_windows(spark, sf_dir):
    samples = windows.lookback_windows(half_features(spark, sf_dir), FEATURES, "demand", 3 * HALF.period, HALF)
    digest = windows.window_digest(F.col("window"), "demand")
    heat = windows.window_digest(F.col("window"), "temperature_2m")["total"].alias("heat")
    return rounded(samples.select("series_id", "ts", "pos", "target", heat, *[c.alias(k) for k, c in digest.items()]))


@query
def lookback_capped(spark, sf_dir):
    table = price_daily(spark, sf_dir).withColumnRenamed("value", "demand")
    samples = windows.lookback_windows(table, ["demand"], "demand", 144, DAILY, cap=2000)
    digest = windows.window_digest(F.col("window"), "demand")
    return rounded(samples.select("series_id", "ts", "pos", "target", *[c.alias(k) for k, c in digest.items()]), 3)


@query
def horizon_targets(spark, sf_dir):
    rows = windows.horizon_targets(half_regular(spark, sf_dir), "value", HALF.horizon, HALF)
    return rounded(
        rows.select(
            "series_id",
            "ts",
            F.element_at("targets", 1).alias("first_target"),
            F.element_at("targets", -1).alias("last_target"),
            F.aggregate("targets", F.lit(0.0), lambda a, v: a + v).alias("total"),
        )
    )


@query
def chrono_split(spark, sf_dir):
    return select.chrono_split(half_features(spark, sf_dir)).select("series_id", "ts", "part")


@query
def holdout_split(spark, sf_dir):
    return select.holdout_split(half_regular(spark, sf_dir), HALF).select("series_id", "ts", "part")


# --- scaling ------------------------------------------------------------------------------------


@query
def minmax_fit(spark, sf_dir):
    return rounded(scaling.minmax_fit(half_features(spark, sf_dir), FEATURES).drop("n", "n_rows"))


@query
def minmax_fit_train(spark, sf_dir):
    return rounded(scaling.minmax_fit(half_features(spark, sf_dir), FEATURES, train_share=0.8).drop("n", "n_rows"))


@query
def minmax_transform(spark, sf_dir):
    table = half_features(spark, sf_dir)
    scaled = scaling.minmax_transform(table, scaling.minmax_fit(table, FEATURES), FEATURES)
    return rounded(scaled.select("series_id", "ts", *FEATURES))


@query
def minmax_inverse(spark, sf_dir):
    table = half_features(spark, sf_dir)
    scaled = scaling.minmax_transform(table, scaling.minmax_fit(table, FEATURES), FEATURES)
    return rounded(scaling.minmax_inverse(scaled, "demand", "demand").select("series_id", "ts", "demand"))


# --- forecasts ------------------------------------------------------------------------------------


@query
def fc_seasonal_naive(spark, sf_dir):
    return rounded(baseline.seasonal_naive(half_newest(spark, sf_dir), HALF))


@query
def fc_kday_average(spark, sf_dir):
    return rounded(baseline.seasonal_naive(half_newest(spark, sf_dir), HALF, k=HALF.k_days, model="kday_average"))


@query
def fc_persistence(spark, sf_dir):
    """Users with less than one season of days repeat their last value."""
    regular = regularise.regularise(user_readings(spark, sf_dir), MONTHLY)
    return rounded(baseline.seasonal_naive(regular, MONTHLY))


@query
def asof_raw_stamps(spark, sf_dir):
    """For every event the user's last purchase value at or before it, at the stamps as they are."""
    events = load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("series_id"), "ts", "event_type", "value")
    bought = events.where("event_type = 'purchase'").select("series_id", "ts", F.col("value").alias("last_purchase"))
    return asof.asof_merge(events.select("event_id", "series_id", "ts"), bought, "last_purchase")


@query
def asof_raw_tolerance(spark, sf_dir):
    """The same over all users by event type, forgetting values older than two minutes."""
    events = load(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("series_id"), F.col("ts").alias("at"), "value")
    shifted = events.select("series_id", (F.col("at") + F.expr("INTERVAL 30 SECONDS")).alias("at"), F.col("value").alias("earlier"))
    return asof.asof_merge(events, shifted, "earlier", ts="at", tolerance=120)


@query
def future_index(spark, sf_dir):
    return baseline.future_index(user_newest(spark, sf_dir), HOURLY, HOURLY.horizon)


@query
def fc_ar1(spark, sf_dir):
    return rounded(regression.ar1(half_regular(spark, sf_dir), HALF))


@query
def fc_ar_p(spark, sf_dir):
    return rounded(regression.ar_forecast(user_regular(spark, sf_dir), HOURLY, max_p=2))


@query
def fc_ar_exog(spark, sf_dir):
    cols = ["is_weekend", "temperature_2m"]
    exog = half_exog(spark, sf_dir)
    ahead = features.future_covariates(exog, HALF, HALF.horizon)
    history = exog.withColumnRenamed("demand", "value")
    return rounded(regression.ar_forecast(history, HALF, max_p=3, exog_cols=cols, future=ahead, model="ar_exog"))


@query
def fc_arma_fixed(spark, sf_dir):
    """Differences and shocks only, near and seasonal, for every user."""
    return rounded(arma.arma_forecast(user_regular(spark, sf_dir), HOURLY, order=((0, 1, 1), (0, 1, 1))))


@query
def fc_arma_seasonal(spark, sf_dir):
    """Lags and shocks, near and seasonal, for every user."""
    return rounded(arma.arma_forecast(user_regular(spark, sf_dir), HOURLY, order=((1, 0, 1), (1, 0, 1))))


@query
def fc_arma(spark, sf_dir):
    """The order search without covariates, in the smaller bounds."""
    return rounded(arma.arma_forecast(user_regular(spark, sf_dir), HOURLY, max_order=(2, 2, 1, 1)))


@query
def fc_arma_exog(spark, sf_dir):
    """The order search with weekend and temperature, in the wide bounds."""
    exog = half_exog(spark, sf_dir)
    ahead = features.future_covariates(exog, HALF, HALF.horizon)
    history = exog.withColumnRenamed("demand", "value")
    return rounded(arma.arma_forecast(history, HALF, exog_cols=["is_weekend", "temperature_2m"], future=ahead, model="arma_exog"))


@query
def fc_stacked_horizon(spark, sf_dir):
    """Stacked blocks on three days of lookback; the last fifth chooses penalty and number of blocks."""
    return rounded(stacked.stacked_horizon(half_regular(spark, sf_dir), HALF))


@query
def fc_boosted_recursive(spark, sf_dir):
    """Boosted trees on three days of lookback, weekend, slot and temperature, rolled out step by step."""
    table = half_exog(spark, sf_dir).withColumnRenamed("demand", "value")
    return rounded(boosted.boosted_recursive(table, HALF, exog_cols=["temperature_2m"], trees=10))


@query
def fc_basis(spark, sf_dir):
    """Trend and season as basis functions, carried on."""
    return rounded(basis.basis_forecast(half_regular(spark, sf_dir), HALF), 4)


@query
def basis_decompose(spark, sf_dir):
    return rounded(basis.basis_decompose(half_regular(spark, sf_dir), HALF), 4)


@query
def nearest_windows(spark, sf_dir):
    """The past windows that look most like the newest one, by series."""
    found = analogue.nearest_windows(half_regular(spark, sf_dir), HALF, HALF.horizon, 3 * HALF.period)
    first, last = F.element_at("continuation", 1), F.element_at("continuation", -1)
    return rounded(found.select("series_id", "rank", "origin", "distance", first.alias("first"), last.alias("last")), 4)


@query
def fc_analogue(spark, sf_dir):
    return rounded(analogue.analogue_forecast(half_regular(spark, sf_dir), HALF), 4)


@query
def fc_lag_recursive(spark, sf_dir):
    return rounded(regression.lag_recursive(half_regular(spark, sf_dir), hourly_weather(spark, sf_dir), HALF))


@query
def fc_direct_horizon(spark, sf_dir):
    return rounded(regression.direct_horizon(half_regular(spark, sf_dir), HALF))


@query
def seasonal_decompose(spark, sf_dir):
    return rounded(regression.seasonal_decompose(half_regular(spark, sf_dir), HALF))


@query
def fc_ensemble_mean(spark, sf_dir):
    return rounded(baseline.ensemble_mean(two_baselines(half_newest(spark, sf_dir), HALF)))


@query
def fc_with_fallback(spark, sf_dir):
    return rounded(baseline.with_fallback(user_daily(spark, sf_dir), DAILY, 4 * DAILY.period, regression.ar1))


# --- evaluation ---------------------------------------------------------------------------------------


@query
def metric_mape_nonzero(spark, sf_dir):
    scores = evaluate.backtest_holdout(user_newest(spark, sf_dir), evaluate.baseline_models(HOURLY), HOURLY)
    return rounded(scores.select("series_id", "model", "mape_nonzero"))


@query
def metrics_by_model(spark, sf_dir):
    """Includes forecasts that lie behind all actuals and so have no errors."""
    regular = half_regular(spark, sf_dir)
    models = evaluate.baseline_models(HALF)
    beyond = baseline.persistence(regular, HALF)
    forecasts = evaluate.holdout_forecasts(regular, models, HALF).unionByName(beyond)
    return rounded(evaluate.metrics(select.validation_part(regular, HALF), forecasts))


@query
def backtest_seasonal(spark, sf_dir):
    return rounded(evaluate.backtest_seasonal(half_newest(spark, sf_dir), HALF))


@query
def backtest_holdout(spark, sf_dir):
    """Hold-out errors of both baselines for every user."""
    return rounded(evaluate.backtest_holdout(user_newest(spark, sf_dir), evaluate.baseline_models(HOURLY), HOURLY))


@query
def models_used(spark, sf_dir):
    """Which model answered for which history, long and short ones alike."""
    regular = stretched.saved_rows(user_histories(spark, sf_dir), HOURLY)
    forecasts = evaluate.forecasts_of(regular, comparison.all_models(HOURLY), HOURLY, HOURLY.horizon)
    return forecasts.groupBy("series_id", "model", "model_used").agg(F.count("yhat").alias("steps"))


@query
def backtest_all_models(spark, sf_dir):
    """Hold-out errors of every model, with and without weather; all read one saved regular table."""
    models = comparison.all_models(HALF, saved(hourly_weather(spark, sf_dir)))
    return rounded(evaluate.backtest_holdout(saved(half_regular(spark, sf_dir)), models, HALF))


@query
def best_of_all_models(spark, sf_dir):
    models = comparison.all_models(HALF, saved(hourly_weather(spark, sf_dir)))
    scores = evaluate.backtest_holdout(saved(half_regular(spark, sf_dir)), models, HALF)
    return rounded(evaluate.compare_models(scores, list(models)))


@query
def backtest_fitted_models(spark, sf_dir):
    """Hold-out errors of the models that fit shocks, blocks, trees, basis functions or past windows."""
    models = evaluate.baseline_models(HALF) | comparison.fitted_models()
    return rounded(evaluate.backtest_holdout(saved(half_regular(spark, sf_dir)), models, HALF), 3)


@query
def best_model(spark, sf_dir):
    models = evaluate.baseline_models(HOURLY)
    scores = evaluate.backtest_holdout(user_newest(spark, sf_dir), models, HOURLY)
    return rounded(evaluate.compare_models(scores, list(models)))


@query
def improvement_over_baseline(spark, sf_dir):
    models = evaluate.baseline_models(HALF) | {"ar1": regression.ar1}
    scores = evaluate.backtest_holdout(half_regular(spark, sf_dir), models, HALF)
    gains = evaluate.improvement(scores, "seasonal_naive")
    return rounded(sinks.with_improvement_text(gains))


@query
def stationarity_df(spark, sf_dir):
    return rounded(regression.stationarity(half_regular(spark, sf_dir), HALF))


@query
def stationarity_lagged(spark, sf_dir):
    return rounded(unitroot.stationarity_lagged(half_regular(spark, sf_dir), HALF))


@query
def stationarity_lagged_users(spark, sf_dir):
    """Daily series of users, with as many lags as a month allows."""
    return rounded(unitroot.stationarity_lagged(user_daily(spark, sf_dir), DAILY))


@query
def interval_coverage(spark, sf_dir):
    regular = user_regular(spark, sf_dir)
    train = select.training_part(regular, HOURLY)
    forecasts = regression.ar_forecast(train, HOURLY, HOURLY.validation_steps)
    return rounded(evaluate.interval_coverage(select.validation_part(regular, HOURLY), forecasts))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regularise, hold out a week, forecast with both baselines, name the best per series."""
    models = evaluate.baseline_models(HALF)
    scores = evaluate.backtest_holdout(half_newest(configure(spark), sf_dir), models, HALF)
    return rounded(evaluate.compare_models(scores, list(models)))
