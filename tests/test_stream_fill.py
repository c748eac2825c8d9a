"""The regular table as a stream of files against the batch table."""

import random

import pytest

from tests.helpers import series
from tidegrid.operators.regularise import regularise
from tidegrid.spec import Spec
from tidegrid.streaming.fill import STORE, stream_regular

SPEC = Spec(chunk=16)
CLOCK = ("clock", 100 * 1440, 0.0)  # moves the time on, so that all before becomes final


@pytest.fixture(autouse=True)
def store(spark):
    spark.conf.set(*STORE)
    yield
    spark.conf.unset(STORE[0])


def rows_of(df):
    return sorted((r.series_id, r.ts, round(r.value, 9), r.pos, r.filled) for r in df.collect())


def streamed(spark, tmp_path, files):
    """Rows that the stream has sent out after reading ``files`` one by one, in a new run for every file."""
    schema = "series_id string, ts timestamp_ntz, value double"
    for rows in files:
        series(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = (
            stream_regular(source, SPEC).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def arriving(seed):
    rng, out = random.Random(seed), []
    for s in ("a", "b", "c"):
        minute = rng.randint(0, 2000)
        for _ in range(60):
            minute += rng.choice((1, 7, 20, 45, 700))
            out += [(s, minute, rng.uniform(-5, 5))] * rng.choice((1, 1, 2))
            if rng.random() < 0.1:
                out.append((s, minute, None))
    # disorder within the delay of an hour
    return sorted(out, key=lambda r: r[1] + rng.uniform(0, 50))


@pytest.mark.parametrize("seed", range(1))
def test_stream_equals_batch(spark, tmp_path, seed):
    data = arriving(seed)
    cuts = [0, len(data) // 3, 2 * len(data) // 3, len(data)]
    files = [data[a:b] for a, b in zip(cuts, cuts[1:])] + [[CLOCK]]
    got = rows_of(streamed(spark, tmp_path, files))
    want = regularise(series(spark, data), SPEC)
    assert got == rows_of(want)


def test_late_readings_and_open_gaps_stay_out(spark, tmp_path):
    files = [[("a", 0, 1.0), ("a", 300, 11.0)], [("a", 5, 99.0), ("a", 600, 0.0)], [("a", 640, 5.0)]]
    got = rows_of(streamed(spark, tmp_path, files))
    want = rows_of(regularise(series(spark, [("a", 0, 1.0), ("a", 300, 11.0)]), SPEC))
    assert got == want  # the bin at 600 is not older than an hour, so the gap before it is open
