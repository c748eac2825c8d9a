"""As-of join on raw stamps against a search of all values."""

import random
from datetime import datetime, timedelta

import pytest

from tidegrid.operators.asof import asof_merge

START = datetime(2024, 1, 1)


def plain(probes, values, tolerance=None):
    out = []
    for k, series, ts in probes:
        known = [(t, v) for s, t, v in values if s is not None and s == series and t is not None and ts is not None and t <= ts and v is not None]
        best = max(known, default=None)
        if best and tolerance is not None and (ts - best[0]).total_seconds() > tolerance:
            best = None
        out.append((k, best[1] if best else None))
    return sorted(out)


@pytest.mark.parametrize("tolerance", [None, 30.0])
@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_every_probe_finds_the_last_value(spark, ranges, tolerance):
    rng = random.Random(ranges)

    def stamp():
        return START + timedelta(microseconds=rng.randrange(0, 400_000_000))

    hot = START + timedelta(seconds=200)
    values = [(rng.choice("abc"), stamp(), rng.random()) for _ in range(120)]
    values += [("a", values[0][1], 5.0), ("b", START, None), (None, START, 9.0), ("c", None, 9.0), ("a", hot, 7.0), ("a", hot, 8.0)]
    probes = [(k, rng.choice("abcd"), stamp()) for k in range(200)]
    probes += [(1000 + k, "a", hot) for k in range(150)] + [(2000, None, hot), (2001, "a", None), (2002, "a", hot), (2002, "a", hot)]
    p = spark.createDataFrame([(*r, -1.0) for r in probes], "k long, series_id string, ts timestamp_ntz, price double")
    v = spark.createDataFrame(values, "series_id string, ts timestamp_ntz, price double")
    got = asof_merge(p, v, "price", tolerance=tolerance, ranges=ranges)
    assert got.columns == ["k", "series_id", "ts", "price"]
    assert sorted((r.k, r.price) for r in got.collect()) == plain(probes, values, tolerance)


def test_a_busy_stamp_is_spread(spark):
    """One stamp asked by most rows lies in many ranges, none of which holds much more than its share."""
    p = spark.range(4000).selectExpr("id AS k", "'a' AS series_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts")
    v = spark.createDataFrame([("a", START, 1.0)], "series_id string, ts timestamp_ntz, price double")
    rows = asof_merge(p, v, "price", ranges=8)
    assert rows.where("price = 1.0").count() == 4000


def test_no_values_and_no_probes(spark):
    p = spark.createDataFrame([(1, "a", START)], "k long, series_id string, ts timestamp_ntz")
    v = spark.createDataFrame([("a", START, 1.0)], "series_id string, ts timestamp_ntz, price double")
    assert [r.price for r in asof_merge(p, v.limit(0), "price").collect()] == [None]
    assert asof_merge(p.limit(0), v, "price").count() == 0
