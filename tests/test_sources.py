"""Readers, sinks, streaming and the whole job, through files."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import column, series, stamp
from tidegrid.functions.parsing import parse_timestamp
from tidegrid.operators import evaluate
from tidegrid.operators.align import first_station
from tidegrid.operators.regularise import resample_mean
from tidegrid.plans.comparison import run_comparison
from tidegrid.sources import sinks, tables
from tidegrid.spec import Spec
from tidegrid.streaming.resample import stream_means


def test_wide_csv_with_decimal_commas(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text('stamp,A,B,is_weekend\n01/01/2024 00:00,"1,5","2,0",false\n01/01/2024 00:30,n/a,"3,25",false\nbad,"9","9",true\n')
    schema = "`stamp` string, A string, B string, is_weekend boolean"
    wide = tables.read_wide(spark, str(path), "stamp", ["A", "B"], "is_weekend", schema)
    long = tables.wide_to_long(wide, ["A", "B"])
    rows = {(r["series_id"], r["ts"]): r["value"] for r in long.collect()}
    assert rows[("A", stamp(0))] == 1.5 and rows[("A", stamp(30))] is None and rows[("B", stamp(30))] == 3.25
    with pytest.raises(ValueError):
        tables.read_table(spark, str(path))


def test_scan_reads_only_what_is_used(spark, sf_dir):
    wide = tables.read_wide(spark, f"{sf_dir}/lineitem.parquet", "l_shipdate", ["l_quantity"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:" in plan


def test_weather_documents(spark, tmp_path):
    doc = {"series_id": "a", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, None], "precipitation": [0.0, 2.0]}}
    (tmp_path / "w.json").write_text(json.dumps(doc) + "\n")
    rows = tables.read_weather(spark, str(tmp_path / "w.json"), ["temperature_2m", "precipitation"]).orderBy("ts").collect()
    assert [tuple(r) for r in rows] == [("a", stamp(0), 1.5, 0.0), ("a", stamp(60), None, 2.0)]


def test_whole_job_and_sinks(spark, sf_dir, tmp_path):
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.concat(F.col("event_type"), F.lit("/x")).alias("series_id"), "ts", "value")
    result = run_comparison(raw, Spec())
    assert result.best.count() == 15
    sinks.write_forecast_table(result.table, str(tmp_path / "table"))
    back = spark.read.option("header", True).csv(str(tmp_path / "table"))
    assert back.count() == result.table.count()
    names = {f"{t}/x" for t in ("click", "view", "error", "signup", "purchase")}
    assert {r[0] for r in back.select("series_id").distinct().collect()} == names
    sinks.write_forecast_table(result.table, str(tmp_path / "parquet"), "parquet")
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == result.table.count()
    models = ["seasonal_naive", "kday_average"]
    sinks.write_report(result.report, str(tmp_path / "report"), models)
    schema = "series_id string, line_no int, line string"
    lines = spark.read.option("sep", "\t").schema(schema).csv(str(tmp_path / "report")).where("series_id = 'click/x'")
    text = column(lines, "line", "line_no")
    assert text[0] == "Model comparison: click/x" and text[2].split() == ["Metric", *models, "Best", "model"]
    assert [t.split()[0] for t in text[4:7]] == ["MAPE", "MSE", "wMAPE"] and text[-1].startswith("Lower is better")
    header = result.table.columns
    assert header[:2] == ["series_id", "timestamp"] and "demand_history" in header


def test_series_that_share_a_folder_stay_apart(spark, tmp_path):
    rows = [("a/b", 1), ("a_b", 2)]
    table = spark.createDataFrame(rows, "series_id string, v int").withColumn("timestamp", F.lit(stamp(0)))
    for layout in ("series", "date", "bucket"):
        sinks.write_forecast_table(table, str(tmp_path / layout), "parquet", layout)
        back = spark.read.parquet(str(tmp_path / layout))
        assert sorted((r.series_id, r.v) for r in back.collect()) == rows


@pytest.mark.parametrize(
    "text, minutes",
    [("1/1/2024 0:30", 30), ("01/01/2024 01:00:00", 60), ("2024-01-01 00:30", 30), ("2024-01-01T00:30:00.500", 30), ("1/1/2024", 0), ("13/13/2024", None)],
)
def test_stamps_as_people_write_them(spark, text, minutes):
    got = spark.createDataFrame([(text,)], "t string").select(F.date_trunc("minute", parse_timestamp(F.col("t"))).cast("timestamp_ntz"))
    assert got.first()[0] == (None if minutes is None else stamp(minutes))


def test_interval_means_and_stations(spark):
    rows = [("a", "m", 1.0, 0.0, 2.0), ("a", "m", 3.0, 1.0, 6.0)]
    summary = evaluate.forecast_summary(spark.createDataFrame(rows, "series_id string, model string, yhat double, lower double, upper double"))
    assert (summary.first().mean_lower, summary.first().mean_upper) == (0.5, 4.0)
    stations = spark.createDataFrame([("s", 1, 2.0, 9.0), ("s", 1, 1.0, 10.0)], "station string, k int, x double, y double")
    assert tuple(first_station(stations, "k").first()) == ("s", 1.0, 10.0)


def test_report_marks_missing_scores(spark):
    scores = spark.createDataFrame([("a", "m", None, 1.23456, 2.0)], "series_id string, model string, mape double, mse double, wmape double")
    lines = column(sinks.report_lines(evaluate.compare_models(scores, ["m"]), ["m"]), "line", "line_no")
    assert lines[0].split() == ["MAPE", "N/A", "N/A"] and lines[1].split() == ["MSE", "1.235", "m"]


def test_stream_equals_batch_for_closed_bins(spark, sf_dir, tmp_path):
    readings = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("series_id"), "ts", "value")
    readings.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(readings.schema).parquet(str(tmp_path / "in"))
    job = (
        stream_means(stream, Spec()).writeStream.format("memory").queryName("bins").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    job.awaitTermination(120)
    got = {(r["series_id"], r["ts"]): r["value"] for r in spark.table("bins").collect()}
    want = {(r["series_id"], r["ts"]): r["value"] for r in resample_mean(readings, Spec()).collect()}
    assert 900 < len(got) <= len(want)
    assert all(want[k] == pytest.approx(v) for k, v in got.items())


def test_gaps_of_long_silence(spark):
    """Years between two readings stay one block and are not expanded at once."""
    from tidegrid.operators.gaps import missing_blocks

    raw = series(spark, [("a", 0, 1.0), ("a", 60 * 24 * 365 * 30, 1.0)])
    assert missing_blocks(raw, Spec()).first()["slots"] == 48 * 365 * 30 - 1
