"""A stored regular table after appends against the table made anew of all readings."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import series, stamp
from tidegrid.operators.appended import append, append_batches, regular_rows
from tidegrid.operators.regularise import regularise
from tidegrid.spec import Spec

WEEK = Spec(chunk=48)  # parts of one day


def rows_of(df):
    return sorted((r.series_id, r.ts, round(r.value, 9), r.pos, r.n, r.filled) for r in df.collect())


def opened(df):
    """(layer, generation, part) of the files that a table reads."""
    found = set()
    for name in df.inputFiles():
        layer, generation, part = name.split("/")[-4:-1]
        found.add((layer, int(generation.split("=")[1]), int(part.split("=")[1])))
    return found


def readings(seed, days=20, series_count=3):
    rng = random.Random(seed)
    out = []
    for s in range(series_count):
        first, last = rng.randint(0, 3), rng.randint(6, days)
        quiet = rng.randint(first, last)
        for _ in range(rng.choice((8, 60, 300))):
            minute = rng.randint(first * 1440, last * 1440)
            if not quiet * 1440 <= minute < (quiet + 2) * 1440:
                out += [(f"s{s}", minute, rng.uniform(-5, 5))] * rng.choice((1, 1, 1, 2))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_appends_equal_the_table_made_anew(spark, tmp_path, seed):
    rng, data, path = random.Random(seed), readings(seed), str(tmp_path / "t")
    cut = rng.randint(0, 20 * 1440)
    late = [r for r in data if rng.random() < 0.1]
    batches = [[r for r in data if r[1] < cut], [r for r in data if r[1] >= cut], [("new", 5000, 1.0), ("new", 5000, 3.0)], late]
    taken = []
    for batch in batches:
        append(series(spark, batch), WEEK, path)
        taken += batch
        if taken:
            assert rows_of(regular_rows(spark, path, WEEK)) == rows_of(regularise(series(spark, taken), WEEK))


def test_an_append_writes_only_from_the_last_edge_on(spark, tmp_path):
    path = str(tmp_path / "t")
    steady = [("a", m, float(m)) for m in range(0, 10 * 1440, 30)]
    append(series(spark, steady), WEEK, path)
    append(series(spark, [("a", m, 1.0) for m in range(10 * 1440, 10 * 1440 + 300, 30)]), WEEK, path)
    first = int(stamp(0).timestamp()) // 1800 // 48
    files = opened(regular_rows(spark, path, WEEK))
    assert {p for layer, g, p in files if layer == "rows" and g == 2} == {first + 10}
    assert {p for layer, g, p in files if layer == "rows" and g == 1} == set(range(first, first + 10))
    # a gap behind the last reading belongs to the append as well, from the part of that reading on
    append(series(spark, [("a", 13 * 1440 + 60, 5.0)]), WEEK, path)
    files = opened(regular_rows(spark, path, WEEK))
    assert {p for layer, g, p in files if layer == "rows" and g == 3} == set(range(first + 10, first + 14))
    assert {p for layer, g, p in files if layer == "edges" and g == 3} == {first + 13}
    # a late reading changes its own part only, where its neighbours are readings
    append(series(spark, [("a", 4 * 1440 + 615, 99.0)]), WEEK, path)
    files = opened(regular_rows(spark, path, WEEK))
    assert {p for layer, g, p in files if layer == "rows" and g == 4} == {first + 4}


def test_slots_bound_the_files_that_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append(series(spark, [("a", m, float(m)) for m in range(0, 10 * 1440, 30)]), WEEK, path)
    low = int(stamp(0).timestamp()) // 1800 + 5 * 48 + 7
    got = regular_rows(spark, path, WEEK, low, low + 60)
    assert {p - low // 48 for layer, _, p in opened(got) if layer == "rows"} == {0, 1}
    want = regular_rows(spark, path, WEEK).where((F.col("pos") >= 247) & (F.col("pos") <= 307))
    assert rows_of(got) == rows_of(want) and got.count() == 61


def test_batches_count_once_and_unusable_rows_never(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = series(spark, [("a", None, 1.0), (None, 5, 1.0), ("a", 5, None), ("a", 5, float("nan"))])
    append(empty, WEEK, path, "none")
    with pytest.raises(ValueError):
        regular_rows(spark, path, WEEK)
    append(series(spark, [("a", 5, 1.0)]), WEEK, path, "one")
    for _ in range(2):
        append(series(spark, [("a", 5, 4.0), ("a", 65, 4.0)]), WEEK, path, "two")
    assert [round(r[2], 9) for r in rows_of(regular_rows(spark, path, WEEK))] == [2.5, 3.25, 4.0]
    with pytest.raises(ValueError):
        append(series(spark, [("a", 5, 1.0)]), Spec(chunk=96), path)


def test_an_append_that_dies_is_never_seen(spark, tmp_path, monkeypatch):
    from tidegrid.operators import appended

    path, one, two = str(tmp_path / "t"), [("a", 5, 1.0)], [("a", 3000, 7.0)]
    append(series(spark, one), WEEK, path, "one")
    before = rows_of(regular_rows(spark, path, WEEK))
    write = appended._write

    def dying(df, path, layer, at, order):
        write(df, path, layer, at, order)
        if layer == "rows":
            raise RuntimeError("executor lost")

    monkeypatch.setattr(appended, "_write", dying)
    with pytest.raises(RuntimeError):
        append(series(spark, two), WEEK, path, "two")
    monkeypatch.setattr(appended, "_write", write)
    assert rows_of(regular_rows(spark, path, WEEK)) == before
    append(series(spark, two), WEEK, path, "two")
    assert rows_of(regular_rows(spark, path, WEEK)) == rows_of(regularise(series(spark, one + two), WEEK))


def test_stream_of_files_into_the_table(spark, tmp_path):
    data, path = readings(11), str(tmp_path / "t")
    for k in range(3):
        series(spark, data[k::3]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("series_id string, ts timestamp_ntz, value double").option("maxFilesPerTrigger", 1)
    for _ in range(2):  # the second run finds nothing new
        query = (
            stream.parquet(str(tmp_path / "in")).writeStream.foreachBatch(append_batches(WEEK, path))
            .option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert rows_of(regular_rows(spark, path, WEEK)) == rows_of(regularise(series(spark, data), WEEK))
