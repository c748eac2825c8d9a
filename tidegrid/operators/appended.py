"""A regular table that is kept on disk and takes in further readings.

Three layers lie next to each other, cut by time into *parts* of ``Spec.chunk`` slots:

* ``stamps``: sum and count of the readings of every stamp, so that duplicates which arrive later
  still count in its mean,
* ``edges``: first and last slot with a reading and their values, one row per series and part,
* ``rows``: the filled grid.

An append changes the grid from the last reading before a new one to the first reading after it, and
nothing else. The edges say which parts that are; only they are read and written again. Positions
depend on the whole series and are not stored: ``regular_rows`` derives them from the edges.

Every append writes a generation of its own and last a manifest, a row for every part of a layer that
names the generation it lies in. A job that dies before leaves no manifest, so readers never see half
an append and the next one starts from the state before. There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import slot_of, slot_start
from tidegrid.operators.chunked import with_neighbours
from tidegrid.operators.regularise import drop_missing, filled_value
from tidegrid.session import saved
from tidegrid.spec import Spec

LAYERS = ("stamps", "edges", "rows")
MANIFEST = "layer string, part bigint, generation bigint, batch string, step bigint, chunk bigint, series string"

Manifest = dict[str, dict[int, int]]


def _part(slot: Column | str, spec: Spec) -> Column:
    return F.floor((F.col(slot) if isinstance(slot, str) else slot) / F.lit(spec.chunk))


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    """All manifests; none before the first append."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(MANIFEST + ", at bigint").parquet(f"{path}/manifest")


def _newest(spark: SparkSession, path: str, spec: Spec) -> tuple[int, Manifest, DataFrame | None]:
    """The number of the last append, where each part lies (some rows per ``Spec.chunk`` slots of time), all manifests."""
    live: Manifest = {layer: {} for layer in LAYERS}
    known = _manifests(spark, path)
    last = known.agg(F.max("at")).first()[0] if known is not None else None
    if last is None:
        return 0, live, None
    for r in known.where(F.col("at") == last).collect():
        if (r.step, r.chunk) != (spec.step, spec.chunk):
            raise ValueError(f"the table has steps of {r.step} seconds in parts of {r.chunk}")
        if r.layer in live:
            live[r.layer][r.part] = r.generation
    return last, live, known


def _read(spark: SparkSession, path: str, layer: str, live: Manifest, schema: str, parts: set[int] | None = None) -> DataFrame:
    """Rows of the named parts of a layer, or of all; no other file is listed or opened."""
    schema = f"{schema}, part bigint"
    wanted = [f"{path}/{layer}/generation={g}/part={p}" for p, g in sorted(live[layer].items()) if parts is None or p in parts]
    if not wanted:
        return spark.createDataFrame([], schema)
    fields = [f.split()[0] for f in schema.split(", ")]
    return spark.read.schema(schema).option("basePath", f"{path}/{layer}").parquet(*wanted).select(*fields)


def _write(df: DataFrame, path: str, layer: str, at: int, order: list[str]) -> None:
    """Ranges of (part, series), so a part of many series is many files and small parts share a task."""
    df.repartitionByRange("part", *order).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(f"{path}/{layer}/generation={at}")


def _types(series: str) -> dict[str, str]:
    return {
        "stamps": f"series_id {series}, ts timestamp_ntz, total double, readings bigint",
        "edges": f"series_id {series}, lo bigint, hi bigint, lo_value double, hi_value double",
        "rows": f"series_id {series}, slot bigint, value double, filled boolean",
    }


def _merged(stamps: DataFrame) -> DataFrame:
    return stamps.groupBy("series_id", "part", "ts").agg(F.sum("total").alias("total"), F.sum("readings").alias("readings"))


def _bins(stamps: DataFrame, spec: Spec) -> DataFrame:
    mean = F.col("total") / F.col("readings")
    return stamps.groupBy("series_id", "part", slot_of("ts", spec.step).alias("slot")).agg(F.avg(mean).alias("value"))


def _edges(bins: DataFrame) -> DataFrame:
    return bins.groupBy("series_id", "part").agg(
        F.min("slot").alias("lo"), F.max("slot").alias("hi"),
        F.min_by("value", "slot").alias("lo_value"), F.max_by("value", "slot").alias("hi_value"),
    )


def _changed(edges: DataFrame, touched: DataFrame, spec: Spec) -> DataFrame:
    """Parts in which a touched part of a series changes grid rows: its own and those of the gaps beside it."""
    order = W.partitionBy("series_id").orderBy("part")  # one row per part of a series
    marked = edges.join(touched.withColumn("_new", F.lit(True)), ["series_id", "part"], "left")
    near = marked.select("part", "_new", F.lag("hi").over(order).alias("_before"), F.lead("lo").over(order).alias("_after"))
    first = F.coalesce(_part(F.col("_before") + 1, spec), F.col("part"))
    final = F.coalesce(_part(F.col("_after") - 1, spec), F.col("part"))
    spans = near.where("_new").select(first.alias("first"), final.alias("final")).distinct()
    return spans.select(F.explode(F.sequence("first", "final")).alias("part")).distinct()


def _grid(bins: DataFrame, edges: DataFrame, parts: set[int] | None, spec: Spec) -> DataFrame:
    """Filled rows of the given parts. Outside them the edges stand for the readings; they decide nothing else."""
    known = bins.select("series_id", "slot", "value")
    if parts is not None:
        ends = F.array(*[F.struct(F.col(at).alias("slot"), F.col(f"{at}_value").alias("value")) for at in ("lo", "hi")])
        outside = edges.where(~F.col("part").isin(*parts)).select("series_id", F.explode(F.array_distinct(ends)).alias("_end"))
        known = known.union(outside.select("series_id", "_end.slot", "_end.value"))
    near = with_neighbours(known, ["value"], at="slot", span=spec.chunk)
    stop = F.coalesce(F.col("next_at") - 1, F.col("slot"))
    cut = near.withColumn("part", F.explode(F.sequence(_part("slot", spec), _part(stop, spec))))
    if parts is not None:
        cut = cut.where(F.col("part").isin(*parts))
    lo = F.greatest("slot", F.col("part") * F.lit(spec.chunk))
    hi = F.least(stop, (F.col("part") + 1) * F.lit(spec.chunk) - 1)
    grid = cut.withColumn("at", F.explode(F.sequence(lo, hi)))
    return grid.select(
        "series_id", F.col("at").alias("slot"), filled_value("value", "linear").alias("value"),
        (F.col("at") != F.col("slot")).alias("filled"), "part",
    )


def append(raw: DataFrame, spec: Spec, path: str, batch: str | None = None) -> None:
    """Take ``(series_id, ts, value)`` into the table at ``path``, which the first append creates.

    Afterwards the table is what ``regularise`` makes of all readings so far, also of late ones,
    repeated stamps and new series. Rows without a series, a stamp or a value are left out, as there.
    A ``batch`` that has been taken in before is passed over, so a retried job counts nothing twice;
    without a label, readings that come again count again. A batch without usable rows writes nothing.
    """
    spark = raw.sparkSession
    at, live, known = _newest(spark, path, spec)
    if batch is not None and known is not None and not known.where(F.col("batch") == batch).isEmpty():
        return
    at += 1
    series = raw.schema["series_id"].dataType.simpleString()
    types = _types(series)
    usable = drop_missing(raw, ["ts", "value"]).where(F.col("series_id").isNotNull())
    ts, value = F.col("ts").cast("timestamp_ntz"), F.col("value").cast("double")
    fresh = usable.select("series_id", ts.alias("ts"), value.alias("total"), F.lit(1).cast("bigint").alias("readings"))
    fresh = saved(_merged(fresh.withColumn("part", _part(slot_of("ts", spec.step), spec))))
    touched = fresh.select("series_id", "part").distinct()
    parts = {r.part for r in touched.select("part").distinct().collect()}  # as many as the batch spans in time
    if not parts:
        return

    old = _read(spark, path, "stamps", live, types["stamps"], parts)
    _write(_merged(old.unionByName(fresh)), path, "stamps", at, ["series_id", "ts"])
    live["stamps"] |= dict.fromkeys(parts, at)
    _write(_edges(_bins(_read(spark, path, "stamps", live, types["stamps"], parts), spec)), path, "edges", at, ["series_id"])
    live["edges"] |= dict.fromkeys(parts, at)

    edges = _read(spark, path, "edges", live, types["edges"])
    again = {r.part for r in _changed(edges, touched, spec).collect()}
    bins = _bins(_read(spark, path, "stamps", live, types["stamps"], again), spec)
    everything = again >= set(live["rows"]) | set(live["edges"])
    _write(_grid(bins, edges, None if everything else again, spec), path, "rows", at, ["series_id", "slot"])
    live["rows"] |= dict.fromkeys(again, at)

    rows = [(layer, p, g, batch, spec.step, spec.chunk, series) for layer in LAYERS for p, g in live[layer].items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/at={at}")


def append_batches(spec: Spec, path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` of a stream of readings: every batch counts once, also when it is run again."""
    return lambda readings, number: append(readings, spec, path, f"stream-{number}")


def regular_rows(spark: SparkSession, path: str, spec: Spec, first: int | None = None, final: int | None = None) -> DataFrame:
    """The regular table at ``path`` with ``pos`` and ``n``; ``first`` and ``final`` bound the slots to read."""
    _, live, known = _newest(spark, path, spec)
    if known is None:
        raise ValueError(f"no table at {path}")
    types = _types(known.select("series").first()[0])
    low, high = (None if s is None else s // spec.chunk for s in (first, final))
    parts = {p for p in live["rows"] if (low is None or p >= low) and (high is None or p <= high)}
    rows = _read(spark, path, "rows", live, types["rows"], parts)
    if first is not None:
        rows = rows.where(F.col("slot") >= first)
    if final is not None:
        rows = rows.where(F.col("slot") <= final)
    ends = _read(spark, path, "edges", live, types["edges"]).groupBy("series_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # the bounds of a series, once for every part of it
    ends = ends.withColumn("part", F.explode(F.sequence(_part("lo", spec), _part("hi", spec))))
    return rows.join(ends, ["series_id", "part"]).select(
        "series_id", slot_start("slot", spec.step).alias("ts"), "value",
        (F.col("slot") - F.col("lo")).alias("pos"), (F.col("hi") - F.col("lo") + 1).alias("n"), "filled",
    )
