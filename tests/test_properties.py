"""Random series against pandas, and invariants of every result."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import START, regular
from tidegrid.operators import align, baseline, features, regression, regularise, scaling
from tidegrid.operators.chunked import with_position
from tidegrid.spec import Spec

RELAXED = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
# Minutes after the start and values; collisions and long gaps are likely.
READINGS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.integers(0, 120), st.integers(0, 4000)), st.floats(-50, 50, width=32)),
    min_size=1, max_size=40,
)


def frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["series_id", "m", "value"])
    pdf["ts"] = START + pd.to_timedelta(pdf["m"], unit="min")
    df = spark.createDataFrame([(s, t.to_pydatetime(), float(v)) for s, t, v in zip(pdf.series_id, pdf.ts, pdf.value)], "series_id string, ts timestamp_ntz, value double")
    return pdf, df


def pandas_regular(g):
    s = g.set_index("ts")["value"].astype(float).sort_index()
    s = s.groupby(level=0).mean().resample("30min").mean()
    return s.interpolate(method="time")


@RELAXED
@given(rows=READINGS, chunk=st.sampled_from([1, 3, 7, 4096]))
def test_regularise_equals_pandas(spark, rows, chunk):
    pdf, df = frame(spark, rows)
    out = regularise.regularise(df, Spec(chunk=chunk)).toPandas()
    assert out["value"].notna().all()
    for s, g in pdf.groupby("series_id"):
        want = pandas_regular(g)
        got = out[out.series_id == s].sort_values("ts")
        np.testing.assert_allclose(got["value"], want.to_numpy(), rtol=1e-9, atol=1e-9)
        assert list(got["ts"]) == list(want.index)
        assert list(got["pos"]) == list(range(len(want))) and set(got["n"]) == {len(want)}


@RELAXED
@given(rows=READINGS, chunk=st.sampled_from([1, 3, 4096]), tail=st.integers(1, 60))
def test_tail_equals_the_end_of_the_whole(spark, rows, chunk, tail):
    spec = Spec(chunk=chunk)
    _, df = frame(spark, rows)
    order = ["series_id", "ts"]
    whole = regularise.regularise(df, spec).where(F.col("pos") >= F.col("n") - tail).toPandas().sort_values(order)
    newest = regularise.regularise(df, spec, tail).toPandas().sort_values(order)
    pd.testing.assert_frame_equal(whole.reset_index(drop=True), newest.reset_index(drop=True))


@RELAXED
@given(rows=READINGS, chunk=st.sampled_from([2, 5, 4096]))
def test_fills_equal_pandas(spark, rows, chunk):
    spec = Spec(chunk=chunk)
    pdf, df = frame(spark, rows)
    grid = regularise.fill_grid(regularise.clean_bins(df, spec), spec, how="none").select("series_id", "ts", "value")
    fwd = regularise.ffill(grid, ["value"], spec).toPandas()
    back = regularise.bfill(grid, ["value"], spec).toPandas()
    numbered = with_position(grid.withColumn("slot", F.unix_seconds(F.col("ts").cast("timestamp")) / 1800), at="slot", span=chunk).toPandas()
    for s, g in pdf.groupby("series_id"):
        bins = g.set_index("ts")["value"].astype(float).sort_index().groupby(level=0).mean().resample("30min").mean()
        for got, want in ((fwd, bins.ffill()), (back, bins.bfill())):
            mine = got[got.series_id == s].sort_values("ts")["value"]
            np.testing.assert_allclose(mine, want.to_numpy(), rtol=1e-9, atol=1e-9)
        pos = numbered[numbered.series_id == s].sort_values("ts")
        assert list(pos["pos"]) == list(range(len(bins))) and set(pos["n"]) == {len(bins)}


@RELAXED
@given(rows=READINGS, hours=READINGS, chunk=st.sampled_from([2, 5, 4096]))
def test_fused_features_equal_joined_features(spark, rows, hours, chunk):
    """One-pass alignment gives what upsampling and joining give."""
    spec = Spec(chunk=chunk)
    _, demand = frame(spark, rows)
    _, raw = frame(spark, hours)
    weather = raw.groupBy("series_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.avg("value").alias("temperature_2m"))
    regular = regularise.regularise(demand, spec)
    wide = align.upsample(weather, spec, ["temperature_2m"])
    joined = align.align_inner(regular.select("series_id", "ts", "value"), wide, ["temperature_2m"])
    fused = features.feature_matrix(demand, weather, spec, days=None).select("series_id", "ts", F.col("demand").alias("value"), "temperature_2m")
    order = ["series_id", "ts"]
    # a series whose weather does not meet its demand keeps its rows, with zeros
    alone = regular.join(joined.select("series_id").distinct(), "series_id", "left_anti").select("series_id", "ts", "value")
    joined = joined.unionByName(alone.withColumn("temperature_2m", F.lit(0.0)))
    a, b = joined.toPandas().sort_values(order), fused.toPandas().sort_values(order)
    assert list(a["ts"]) == list(b["ts"])
    np.testing.assert_allclose(a[["value", "temperature_2m"]], b[["value", "temperature_2m"]], rtol=1e-9, atol=1e-9)
    filled = align.align_left_fill(regular.select("series_id", "ts"), wide, ["temperature_2m"], spec)
    exog = features.exog_matrix(demand, weather, spec).select("series_id", "ts", "temperature_2m")
    c, d = filled.toPandas().sort_values(order), exog.toPandas().sort_values(order)
    assert list(c["ts"]) == list(d["ts"])
    np.testing.assert_allclose(c["temperature_2m"].astype(float), d["temperature_2m"].astype(float), rtol=1e-9, atol=1e-9)


@RELAXED
@given(rows=READINGS, lags=st.sampled_from([(2, 1), (1,), (3, 2, 1)]), steps=st.integers(1, 60))
def test_lag_fallback_equals_asof(spark, rows, lags, steps):
    spec = Spec()
    _, df = frame(spark, rows)
    regular = regularise.regularise(df, spec)
    ahead = baseline.future_index(regular, spec, steps).select("series_id", "ts")
    order = ["series_id", "ts"]
    a = align.asof_fallback(ahead, regular, "value", spec, lags).toPandas().sort_values(order)
    b = align.lag_fallback(regular, "value", spec, steps, lags).toPandas().sort_values(order)
    assert list(a["ts"]) == list(b["ts"]) and len(b) == steps * regular.select("series_id").distinct().count()
    np.testing.assert_allclose(a["value"], b["value"], rtol=1e-9, atol=1e-9)


@RELAXED
@given(rows=READINGS, steps=st.integers(1, 130), k=st.sampled_from([0, 1, 2, 3]))
def test_seasonal_naive_equals_numpy(spark, rows, steps, k):
    spec = Spec(period=5)
    pdf, df = frame(spark, rows)
    out = baseline.seasonal_naive(regularise.regularise(df, spec), spec, steps, k).toPandas()
    for s, g in pdf.groupby("series_id"):
        y = pandas_regular(g)
        if len(y) < 5:
            want = np.full(steps, y.iloc[-1])
        else:
            tail = y.to_numpy()[-5 * max(k, 1) :]
            template = [tail[i::5].mean() for i in range(5)]
            want = np.resize(template, steps)
        got = out[out.series_id == s].sort_values("h")
        np.testing.assert_allclose(got["yhat"], want, rtol=1e-9, atol=1e-9)
        assert got["ts"].iloc[0] == y.index[-1] + pd.Timedelta("30min") and list(got["h"]) == list(range(1, steps + 1))


@pytest.mark.parametrize("bad", [{"step": 7 * 3600}, {"step": 0}, {"period": 0}])
def test_spec_rejects(bad):
    with pytest.raises(ValueError):
        Spec(**bad)


def test_no_side_that_grows_goes_through_the_driver(spark):
    """Sizes taken from the files read say nothing of grids and lists; only a model per horizon step is sent to all."""
    spec = Spec(period=4, chunk=16, k_days=2)
    table = regular(spark, range(40)).unionByName(regular(spark, [1.0] * 9, series_id="b"))
    scaled = scaling.minmax_transform(table, scaling.minmax_fit(table, ["value"]), ["value"], 16)
    results = [
        regularise.regularise(table.select("series_id", "ts", "value"), spec),
        scaled,
        regression.ar_forecast(table, spec, 3, min_rows=0),
        regression.lag_recursive(table, None, spec, 3, lags=[1, 4]),
    ]
    for df in results:
        assert df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    df = regression.direct_horizon(table, spec, 3)
    assert df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("BroadcastExchange") == 1
