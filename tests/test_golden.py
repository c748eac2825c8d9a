"""Small cases with known results."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import column, regular, series, stamp
from tidegrid.functions import calendar as cal
from tidegrid.functions.parsing import parse_decimal, parse_timestamp
from tidegrid.operators import align, baseline, evaluate, features, gaps, regularise, scaling, select, windows
from tidegrid.spec import Spec

CHUNKS = [2, 4096]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_duplicates_bins_interpolation(spark, chunk):
    raw = series(spark, [("a", 0, 1.0), ("a", 0, 3.0), ("a", 40, 5.0), ("a", 130, 11.0), ("a", 140, None), ("a", None, 4.0)])
    out = regularise.regularise(raw, Spec(chunk=chunk))
    assert column(out, "value") == [2.0, 5.0, 7.0, 9.0, 11.0]
    assert column(out, "pos") == [0, 1, 2, 3, 4]
    stats = regularise.fill_stats(out).first()
    assert (stats["points"], stats["filled"]) == (5, 2)


@pytest.mark.parametrize("chunk", CHUNKS)
def test_upsample_stops_at_last_hour(spark, chunk):
    hourly = series(spark, [("a", 0, 1.0), ("a", 60, 3.0), ("a", 120, 2.0)])
    assert column(align.upsample(hourly, Spec(chunk=chunk), ["value"]), "value") == [1.0, 2.0, 3.0, 2.5, 2.0]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_missing_blocks(spark, chunk):
    raw = series(spark, [("a", 0, 1.0), ("a", 90, 1.0), ("a", 210, 1.0), ("a", 10, 5.0)])
    spec = Spec(chunk=chunk)
    blocks = gaps.missing_blocks(raw, spec).orderBy("start").collect()
    assert [(b["start"], b["end"], b["slots"]) for b in blocks] == [(stamp(30), stamp(60), 2), (stamp(120), stamp(180), 3)]
    assert gaps.top_missing_blocks(raw, spec, top=1).first()["slots"] == 3
    assert column(gaps.missing_slots(raw, spec), "ts") == [stamp(m) for m in (30, 60, 120, 150, 180)]


def test_off_grid_reading_covers_its_slot_only_in_bin_mode(spark):
    raw = series(spark, [("a", 10, 1.0), ("a", 60, 1.0)])
    spec = Spec()
    assert column(gaps.missing_slots(raw, spec), "ts") == [stamp(0), stamp(30)]
    assert column(gaps.missing_slots(raw, spec, "bin"), "ts") == [stamp(30)]
    lonely = series(spark, [("a", 10, 1.0)])
    assert column(gaps.missing_slots(lonely, spec), "ts") == [stamp(0), stamp(30)]


@pytest.mark.parametrize(
    "k, expected", [(0, [7, 8, 9, 10, 7, 8]), (2, [5, 6, 7, 8, 5, 6]), (3, [5, 6, 5, 6, 5, 6])]
)
def test_seasonal_forecasts(spark, k, expected):
    out = baseline.seasonal_naive(regular(spark, range(1, 11)), Spec(period=4), 6, k)
    assert column(out, "yhat", "h") == [float(v) for v in expected]
    assert column(out, "ts", "h")[0] == stamp(300)


def test_persistence_is_recorded(spark):
    out = baseline.seasonal_naive(regular(spark, [1, 2, 3]), Spec(period=4), 3, 0)
    assert column(out, "yhat", "h") == [3.0, 3.0, 3.0]
    assert set(column(out, "model_used", "h")) == {"persistence"}
    averaged = baseline.seasonal_naive(regular(spark, [1, 2, 3]), Spec(period=4), 3, 7)
    assert column(averaged, "yhat", "h") == [3.0, 3.0, 3.0]


def test_seasonal_lags(spark):
    out = windows.seasonal_lags(regular(spark, range(1, 22)), Spec(period=3))
    assert column(out, "lag_value") == [None] * 3 + [float(v) for v in range(1, 19)]
    assert column(out, "lag_mean") == [None] * 3 + [1, 2, 3, 2.5, 3.5, 4.5, 4, 5, 6, 5.5, 6.5, 7.5, 7, 8, 9, 8.5, 9.5, 10.5]


def _score(spark, y, yhat):
    actual = regular(spark, y)
    forecast = regular(spark, yhat).select("series_id", F.lit("m").alias("model"), "ts", F.col("value").alias("yhat"))
    return evaluate.metrics(actual, forecast).first()


def test_metrics(spark):
    row = _score(spark, [2, 4, 5], [1, 5, 5])
    assert row["mape"] == pytest.approx(25) and row["mse"] == pytest.approx(2 / 3)
    assert row["wmape"] == pytest.approx(200 / 11)
    zero = _score(spark, [0, 1, 2], [0, 1, 1])
    assert zero["mape"] is None and zero["mape_nonzero"] == pytest.approx(25)


def test_metrics_without_common_stamps(spark):
    late = regular(spark, [1, 2]).select("series_id", F.lit("m").alias("model"), (F.col("ts") + F.expr("INTERVAL 9 DAYS")).alias("ts"), F.col("value").alias("yhat"))
    row = evaluate.metrics(regular(spark, [1, 2]), late).first()
    assert row["n"] == 0 and all(row[m] is None for m in ("mape", "mse", "wmape", "rmse"))
    best = evaluate.compare_models(evaluate.metrics(regular(spark, [1, 2]), late), ["m"])
    assert set(column(best, "best_model", "metric")) == {"N/A"}


def test_tie_goes_to_the_model_listed_first(spark):
    scores = spark.createDataFrame(
        [("a", "x", 1.0, 2.0, 3.0), ("a", "y", 1.0, 1.0, None)], "series_id string, model string, mape double, mse double, wmape double"
    )
    best = {r["metric"]: r["best_model"] for r in evaluate.compare_models(scores, ["y", "x"]).collect()}
    assert best == {"mape": "y", "mse": "y", "wmape": "x"}


def test_improvement(spark):
    scores = spark.createDataFrame(
        [("a", "b", 10.0, 0.0, None), ("a", "m", 8.0, 1.0, 2.0)], "series_id string, model string, mape double, mse double, wmape double"
    )
    gains = {r["metric"]: r["improvement"] for r in evaluate.improvement(scores, "b").collect()}
    assert gains == {"mape": pytest.approx(20), "mse": None, "wmape": None}


@pytest.mark.parametrize("chunk", CHUNKS)
def test_asof(spark, chunk):
    values = series(spark, [("a", 0, 1.0), ("a", 30, 2.0), ("a", 60, None), ("a", 90, None)])
    probes = series(spark, [("a", 120, 0.0), ("a", -10, 0.0), ("a", 0, 0.0), ("a", 29, 0.0), ("b", 30, 0.0)])
    probes = probes.withColumnRenamed("value", "x")
    out = align.asof_lookup(probes, values, "value", Spec(chunk=chunk)).orderBy("series_id", "ts")
    assert [r["value"] for r in out.collect()] == [None, 1.0, 1.0, 2.0, None]


def test_scaling(spark):
    table = regular(spark, [1, 3, 5]).withColumn("flat", F.lit(7.0))
    scaled = scaling.minmax_transform(table, scaling.minmax_fit(table, ["value", "flat"]), ["value", "flat"])
    assert column(scaled, "value") == [0.0, 0.5, 1.0]
    assert column(scaled, "flat") == [0.0, 0.0, 0.0]
    assert column(scaling.minmax_inverse(scaled, "value", "value"), "value") == [1.0, 3.0, 5.0]
    train = scaling.minmax_fit(table, ["value"], train_share=0.7).first()
    assert (train["value_min"], train["value_max"]) == (1.0, 3.0)


@pytest.mark.parametrize("chunk", CHUNKS)
def test_edge_fills(spark, chunk):
    spec = Spec(chunk=chunk)

    def slots(values):
        rows = [("a", i, v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "series_id string, slot bigint, value double")

    assert column(regularise.fill_grid(slots([None, 2.0, None, 4.0]), spec), "value") == [None, 2.0, 3.0, 4.0]
    assert column(regularise.fill_grid(slots([1.0, 2.0, None, None]), spec), "value") == [1.0, 2.0, 2.0, 2.0]
    assert column(regularise.fill_grid(slots([None, 2.0, None, 4.0]), spec, how="pad"), "value") == [2.0, 2.0, 2.0, 4.0]
    rows = regularise.fill_grid(slots([None, 2.0, None, 4.0, None]), spec, how="none").select("series_id", "ts", "value")
    assert column(regularise.ffill(rows, ["value"], spec), "value") == [None, 2.0, 2.0, 4.0, 4.0]
    assert column(regularise.bfill(rows, ["value"], spec), "value") == [2.0, 2.0, 4.0, 4.0, None]
    assert column(regularise.interpolate_rows(rows, ["value"], spec), "value") == [2.0, 2.0, 3.0, 4.0, 4.0]


def test_calendar(spark):
    ts = F.lit("2024-01-06 13:30:00").cast("timestamp_ntz")
    row = spark.range(1).select(cal.hour_of_day(ts), cal.day_of_week(ts), cal.day_of_year(ts), cal.is_weekend(ts)).first()
    assert tuple(row) == (13.5, 5.0, 6.0, True)


def test_parsing(spark):
    cells = ["12,5", "3.25", " 7 ", "n/a", "NaN", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert [r[0] for r in df.select(parse_decimal(F.col("c"))).collect()] == [12.5, 3.25, 7.0, None, None, None]
    stamps = ["02/01/2024 03:30", "02/01/2024 03:30:15", "02/01/2024", "2024-01-02", "31/02/2024", "2.1.24", None]
    df = spark.createDataFrame([(c,) for c in stamps], "c string")
    assert [r[0] for r in df.select(parse_timestamp(F.col("c"))).collect()] == [
        datetime(2024, 1, 2, 3, 30), datetime(2024, 1, 2, 3, 30, 15), datetime(2024, 1, 2), datetime(2024, 1, 2), None, None, None,
    ]


def test_nan_is_missing(spark):
    raw = series(spark, [("a", 0, 1.0), ("a", 30, float("nan")), ("a", 60, 3.0)])
    assert column(regularise.regularise(raw, Spec()), "value") == [1.0, 2.0, 3.0]


def test_flags_first_per_stamp_and_bin(spark):
    rows = [("a", stamp(0), True, 2), ("a", stamp(0), False, 1), ("a", stamp(10), True, 3), ("a", stamp(95), True, 4)]
    flags = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, is_weekend boolean, ingest_order bigint")
    assert column(regularise.regularise_flags(flags, Spec()), "is_weekend") == [False, False, False, True]


@pytest.mark.parametrize("chunk", [2, 4096])
def test_weather_edges(spark, chunk):
    spec = Spec(chunk=chunk)
    demand = series(spark, [("a", 30 * i, float(i)) for i in range(8)] + [("b", 0, 1.0), ("b", 30, 2.0)])
    weather = series(spark, [("a", 60, 10.0), ("a", 120, 20.0), ("b", 600, 5.0)]).withColumnRenamed("value", "temperature_2m")
    left = features.covariates(demand, weather, spec).where("series_id = 'a'")
    assert column(left, "temperature_2m") == [10.0, 10.0, 10.0, 15.0, 20.0, 20.0, 20.0, 20.0]
    # Weather that does not overlap the demand counts as absent.
    assert column(features.covariates(demand, weather, spec).where("series_id = 'b'"), "temperature_2m") == [0.0, 0.0]
    assert column(features.exog_matrix(demand, weather, spec).where("series_id = 'b'"), "temperature_2m") == [None, None]
    inner = features.feature_matrix(demand, weather, spec)
    assert [(r["demand"], r["temperature_2m"], r["pos"], r["n"]) for r in inner.where("series_id = 'b'").orderBy("ts").collect()] == [
        (1.0, 0.0, 0, 2), (2.0, 0.0, 1, 2),
    ]
    inner = inner.where("series_id = 'a'")
    assert [(r["demand"], r["temperature_2m"], r["pos"], r["n"]) for r in inner.orderBy("ts").collect()] == [
        (2.0, 10.0, 0, 3), (3.0, 15.0, 1, 3), (4.0, 20.0, 2, 3),
    ]
    none = features.feature_matrix(demand, None, spec).where("series_id = 'a'")
    assert column(none, "temperature_2m") == [0.0] * 8 and column(none, "pos") == list(range(8))


def test_station_first_match_wins(spark):
    stations = spark.createDataFrame([("x", 1.0, 2), ("x", 9.0, 1), ("y", 5.0, 3)], "station string, x double, row bigint")
    names = spark.createDataFrame([(" x ",), ("z",)], "station string")
    assert [r["x"] for r in align.lookup_stations(names, stations, "row").collect()] == [9.0]
    assert [r[0] for r in align.known_stations(names, stations).collect()] == ["x"]
    assert [r[0] for r in align.unknown_stations(names, stations).collect()] == ["z"]


def test_weekly_cycle_of_short_history(spark):
    # Period 1: a week is seven rows; only three exist.
    table = regular(spark, [1, 2, 3])
    out = align.weekly_cycle(table, ["value"], Spec(period=1), 9)
    assert column(out, "value", "h") == [3.0, 3.0, 3.0, 3.0, 1.0, 2.0, 3.0, 3.0, 3.0]
    assert column(out, "ts", "h") == [stamp(90 + 30 * i) for i in range(9)]


def test_validation_window(spark):
    spec = Spec(period=2, validation_days=2)
    table = regular(spark, range(10))
    assert column(select.training_part(table, spec), "value") == [0.0, 1, 2, 3, 4, 5]
    assert column(select.validation_part(table, spec), "value") == [6.0, 7, 8, 9]
    parts = select.chrono_split(table).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"train": 8, "test": 2}
