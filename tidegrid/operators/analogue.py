"""Forecast from the past windows of a series that look most like its newest one.

This is attention over a series' own past: the newest lookback asks, every earlier lookback whose
continuation is known answers, and the continuations of the nearest are averaged with weights that
fall with distance. Windows are compared by shape: each is moved to mean 0 and scaled to deviation 1.

A series' question is joined to each of its stretches, so all windows are looked at exactly once,
in one matrix-vector product per stretch, and no pair of windows is formed otherwise. Each stretch
keeps its nearest; those meet by series and salt, then by series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import shift
from tidegrid.operators.baseline import seasonal_naive
from tidegrid.spec import Spec

#: Windows that answer.
NEAREST = 24
#: Parts in which a long series' nearest windows are merged first.
SALTS = 32


def _shape(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of windows; a constant one has deviation 0."""
    mean = windows.mean(axis=-1)
    spread = np.sqrt(np.maximum((windows**2).mean(axis=-1) - mean**2, 0.0))
    return mean, np.where(spread > 1e-9 * (1 + np.abs(mean)), spread, 0.0)


def nearest_windows(regular: DataFrame, spec: Spec, steps: int, lookback: int, nearest: int = NEAREST) -> DataFrame:
    """The ``nearest`` past windows of every series: series_id, origin, distance, rank, continuation.

    ``origin`` is the position after the window, ``distance`` the squared distance of the two shapes
    (a constant window has no shape and lies ``lookback`` away from any other), and
    ``continuation`` the ``steps`` values from there on in the window's scale. Ties go to the earlier
    window. A window with a missing value does not answer.
    """
    span = max(spec.chunk, 4 * (lookback + steps))
    lowest = F.floor(F.greatest(F.col("pos") - F.lit(steps - 1), F.lit(0)) / F.lit(span))
    highest = F.floor(F.least(F.col("pos") + F.lit(lookback), F.col("n") - 1) / F.lit(span))
    table = regular.where(F.col("n") >= lookback + steps).select("series_id", "pos", "n", F.col("value").cast("double").alias("z"))
    dealt = table.select("series_id", "pos", "n", "z", F.explode(F.sequence(lowest, highest)).alias("chunk"))
    rows = dealt.groupBy("series_id", "n", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "z"))).alias("r"))
    asked = table.where(F.col("pos") >= F.col("n") - lookback).groupBy("series_id", "n").agg(
        F.sort_array(F.collect_list(F.struct("pos", "z"))).alias("q")
    )
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.lit(span)))
    asked = asked.select("series_id", F.col("q.z").alias("question"), F.explode(parts).alias("chunk"))
    both = rows.join(asked, ["series_id", "chunk"]).select(
        "series_id", "chunk", "n", F.col("r")[0]["pos"].alias("lo"), F.col("r.z").alias("z"), "question"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for k, r in enumerate(batch.select(["chunk", "n", "lo", "z", "question"]).to_pylist()):
                first = max(lookback, r["chunk"] * span)
                last = min((r["chunk"] + 1) * span - 1, r["n"] - steps)
                z, q = np.array(r["z"], float), np.array(r["question"], float)
                if last < first or not np.isfinite(q).all():
                    continue
                pieces = np.lib.stride_tricks.sliding_window_view(z[first - lookback - r["lo"] : last + steps - r["lo"]], lookback + steps)
                windows = pieces[:, :lookback]
                mean, spread = _shape(windows)
                own_mean, own_spread = _shape(q)
                shape = (q - own_mean) / own_spread if own_spread else np.zeros(lookback)
                with np.errstate(invalid="ignore", divide="ignore"):
                    dots = np.where(spread > 0, windows @ shape / spread, 0.0)
                distance = lookback * ((spread > 0) + float(own_spread > 0)) - 2 * dots
                distance = np.where(np.isfinite(pieces).all(axis=1), np.maximum(distance, 0.0), np.inf)
                best = np.lexsort((np.arange(len(distance)), distance))[:nearest]
                best = best[np.isfinite(distance[best])]
                after = pieces[best, lookback:] - mean[best, None]
                after /= np.where(spread[best, None] > 0, spread[best, None], 1.0)
                out[0] += [k] * len(best)
                out[1] += (best + first).tolist()
                out[2] += distance[best].tolist()
                out[3] += after.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("series_id").take(pa.array(out[0], pa.int64())), batch.column("chunk").take(pa.array(out[0], pa.int64())),
                    pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.list_(pa.float64())),
                ],
                names=["series_id", "chunk", "origin", "distance", "continuation"],
            )

    key = regular.schema["series_id"].dataType.simpleString()
    found = both.mapInArrow(run, f"series_id {key}, chunk bigint, origin bigint, distance double, continuation array<double>")
    found = found.withColumn("salt", F.pmod("chunk", F.lit(SALTS)))
    for by in (["series_id", "salt"], ["series_id"]):
        rank = F.row_number().over(W.partitionBy(*by).orderBy("distance", "origin"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= nearest)
    return found.select("series_id", "origin", "distance", "rank", "continuation")


def analogue_forecast(
    regular: DataFrame, spec: Spec, steps: int | None = None, *, lookback: int | None = None, nearest: int = NEAREST, model: str = "analogue"
) -> DataFrame:
    """The weighted continuation of the nearest past windows, in the newest window's scale.

    A window's weight is ``exp(-(distance - smallest) / width)``; the width is the mean distance
    above the smallest of all that answer, so it follows the series. The lookback is three seasons
    by default. A series too short for a past window with its
    continuation gets the K-day average, named in ``model_used``.
    """
    steps = spec.horizon if steps is None else steps
    lookback = 3 * spec.period if lookback is None else lookback
    found = nearest_windows(regular, spec, steps, lookback, nearest)
    w = W.partitionBy("series_id")  # at most ``nearest`` rows
    above = F.col("distance") - F.min("distance").over(w)
    width = F.avg("distance").over(w) - F.min("distance").over(w)
    weighed = found.select("series_id", "continuation", F.when(width > 0, F.exp(-above / width)).otherwise(1.0).alias("weight"))
    rows = weighed.select("series_id", "weight", F.posexplode("continuation").alias("i", "z"))
    mean = rows.groupBy("series_id", "i").agg((F.sum(F.col("weight") * F.col("z")) / F.sum("weight")).alias("z"))
    newest = regular.where((F.col("n") >= lookback + steps) & (F.col("pos") >= F.col("n") - lookback)).groupBy("series_id").agg(
        F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_spread"), F.max("ts").alias("_last")
    )
    h = (F.col("i") + 1).cast("int")
    out = mean.join(newest, "series_id").select(
        "series_id", F.lit(model).alias("model"), h.alias("h"), shift("_last", h, spec.step).alias("ts"),
        (F.col("_mean") + F.col("_spread") * F.col("z")).alias("yhat"), F.lit(model).alias("model_used"),
    )
    rest = seasonal_naive(regular.where(F.col("n") < lookback + steps), spec, steps, k=spec.k_days).withColumn("model", F.lit(model))
    return out.unionByName(rest)
