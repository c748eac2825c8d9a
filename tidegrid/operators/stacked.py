"""All steps at once by stacked blocks, each working on what the blocks before it left.

A sample is the lookback before an origin and the horizon after it, scaled per series. Everything
a linear stack needs to know of the samples is one matrix of sums of products over (1, lookback,
horizon), whose size is fixed by the two lengths. Tasks multiply the samples of a stretch of a
series at a time and add the matrices up; the first share of each series' origins and the rest give
two matrices in the same pass. Blocks, penalties and the number of blocks are then worked out on
the driver from the first matrix and judged on the second, without another look at the rows.

A block compresses its lookback to a few numbers, as many as its width: those that explain most of
the horizon that is left. From them it forecasts that horizon and recalls ("backcasts") the lookback; the
next block sees the lookback without the recall and the horizon without the forecast. Block
forecasts add up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import shift
from tidegrid.operators.baseline import seasonal_naive
from tidegrid.operators.scaling import minmax_fit, minmax_transform
from tidegrid.session import saved
from tidegrid.spec import Spec

# Blocks of both stacks and their widths.
BLOCKS = (4, 4, 4, 8, 8, 8)
#: Penalties tried, as shares of the mean square of a lookback value.
PENALTIES = (1e-6, 1e-4, 1e-3, 1e-2, 1e-1, 1.0)
#: Partial matrices are first added up in this many parts.
SALTS = 16
#: Samples multiplied at a time.
SAMPLES = 4096


@dataclass(frozen=True)
class Stack:
    """``weights`` map (1, lookback) to the horizon; block forecasts and backcasts are kept one by one."""

    weights: np.ndarray
    forecasts: list[np.ndarray]
    backcasts: list[np.ndarray]
    penalty: float
    blocks: int
    train_error: float
    valid_error: float


def window_sums(rows: DataFrame, lookback: int, steps: int, spec: Spec, share: float | None = None) -> DataFrame:
    """Sums of products over all samples: part (0 train, 1 validation), i, and row ``i`` of the matrix.

    ``rows`` has series_id, pos, n and z. A sample starts at every position with a whole lookback
    before and horizon after it and no missing value in them. With ``share``, the first ``floor(share * samples)`` of a series
    train. Rows are dealt by series and stretch; those near a border also go to the next stretch,
    so a sample is whole in the stretch that holds its origin.
    """
    width = 1 + lookback + steps
    span = max(spec.chunk, 4 * (lookback + steps))
    lowest = F.floor(F.greatest(F.col("pos") - F.lit(steps - 1), F.lit(0)) / F.lit(span))
    highest = F.floor(F.least(F.col("pos") + F.lit(lookback), F.col("n") - 1) / F.lit(span))
    dealt = rows.select("series_id", "pos", "n", "z", F.explode(F.sequence(lowest, highest)).alias("_chunk"))
    dealt = dealt.repartition("series_id", "_chunk").sortWithinPartitions("series_id", "_chunk", "pos")
    names = ["_chunk", "pos", "n", "z"]
    # a stretch begins where its number or the position order changes
    fed = dealt.select(*names)
    schema = pa.schema([("part", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width, width))
        seen = np.zeros(2, bool)
        rest = [np.zeros(0)] * len(names)

        def add(chunk: int, pos: np.ndarray, n: int, z: np.ndarray) -> None:
            # origins are the positions of the first step, in this stretch only
            first = max(lookback, chunk * span)
            last = min((chunk + 1) * span - 1, n - steps)
            samples = n - steps - lookback + 1
            train = samples if share is None else int(np.floor(share * samples))
            for low in range(first, last + 1, SAMPLES):
                high = min(low + SAMPLES - 1, last)
                at = low - lookback - int(pos[0])
                piece = z[at : at + (high - low) + lookback + steps]
                x = np.lib.stride_tricks.sliding_window_view(piece, lookback + steps)
                x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                cut = min(max(train - (low - lookback), 0), len(x))
                for part, some in ((0, x[:cut]), (1, x[cut:])):
                    some = some[np.isfinite(some).all(1)]
                    if len(some):
                        total[part] += some.T @ some
                        seen[part] = True

        def groups(cols: list[np.ndarray], whole: bool) -> list[np.ndarray]:
            chunk, pos, n, z = cols
            if not len(pos):
                return cols
            new = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(pos) != 1) | (np.diff(n) != 0)) + 1
            starts = np.concatenate([[0], new]).astype(int)
            ends = np.concatenate([new, [len(pos)]]).astype(int)
            done = len(starts) if whole else len(starts) - 1
            for a, b in zip(starts[:done], ends[:done]):
                add(int(chunk[a]), pos[a:b], int(n[a]), z[a:b])
            return [] if whole else [c[starts[-1] :] for c in cols]

        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(names))]
            rest = groups([np.concatenate([r, c]) if len(r) else c for r, c in zip(rest, cols)], False)
        groups(rest, True)
        for part in np.flatnonzero(seen).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array(list(total[part]), schema.field("row").type)],
                schema=schema,
            )

    partial = fed.mapInArrow(run, "part int, i int, row array<double>")
    salted = partial.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return _added(_added(salted, ["part", "i", "salt"]), ["part", "i"])


def _added(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Element-wise sums of ``row`` by ``keys``."""

    def add(table: pa.Table) -> pa.Table:
        stacked = np.stack(table.column("row").to_pylist()).sum(axis=0)
        first = [table.column(k).slice(0, 1) for k in keys]
        return pa.table([*first, pa.array([stacked.tolist()], pa.list_(pa.float64()))], names=[*keys, "row"])

    kinds = ", ".join(f"{k} int" for k in keys)
    return rows.select(*keys, "row").groupBy(*keys).applyInArrow(add, f"{kinds}, row array<double>")


def _matrices(sums: DataFrame, width: int) -> np.ndarray:
    """Both matrices on the driver: twice (1 + lookback + horizon) squared numbers, whatever the data."""
    out = np.zeros((2, width, width))
    for r in sums.collect():
        out[r["part"], r["i"]] = r["row"]
    return out


def _error(sums: np.ndarray, weights: np.ndarray, inputs: int) -> float:
    """Mean square of horizon minus forecast over all samples and steps."""
    xx, xy, yy = sums[:inputs, :inputs], sums[:inputs, inputs:], sums[inputs:, inputs:]
    left = np.trace(yy) - 2 * np.sum(weights * xy) + np.sum(weights * (xx @ weights))
    return float(max(left, 0.0) / max(sums[0, 0] * yy.shape[0], 1.0))


def stack_blocks(sums: np.ndarray, inputs: int, widths: Sequence[int], penalty: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Forecast and backcast of each block, as maps of the raw (1, lookback).

    ``seen`` maps the raw inputs to what a block sees, ``left`` is the sum of products of that with
    the horizon that is left; both follow from ``sums`` alone.
    """
    xx, xy = sums[:inputs, :inputs], sums[:inputs, inputs:]
    seen = np.eye(inputs)
    done = np.zeros((inputs, xy.shape[1]))
    ridge = penalty * np.trace(xx[1:, 1:]) / max(inputs - 1, 1)
    forecasts, backcasts = [], []
    for width in widths:
        own = seen.T @ xx @ seen
        own = (own + own.T) / 2
        left = seen.T @ (xy - xx @ done)
        eye = np.eye(inputs)
        eye[0, 0] = 0.0
        full = np.linalg.pinv(own + ridge * eye, hermitian=True) @ left
        # directions of the horizon in which the full regression varies most
        spread = full.T @ own @ full
        _, directions = np.linalg.eigh((spread + spread.T) / 2)
        narrow = full @ directions[:, ::-1][:, :width]  # lookback seen -> the block's few numbers
        few = np.linalg.pinv(narrow.T @ own @ narrow, hermitian=True)
        forecast = seen @ narrow @ (few @ narrow.T @ left)
        backcast = seen @ narrow @ (few @ narrow.T @ own)
        backcast[:, 0] = 0.0  # the constant stays
        forecasts.append(forecast)
        backcasts.append(backcast)
        done = done + forecast
        seen = seen - backcast
    return forecasts, backcasts


def fit_stack(sums: np.ndarray, inputs: int, widths: Sequence[int] = BLOCKS, penalties: Sequence[float] = PENALTIES) -> Stack:
    """The penalty and number of blocks of lowest validation error; fitted on the training matrix.

    Blocks are added while the validation error falls (early stopping) under each penalty. Without
    validation samples the training error decides. Ties take the larger penalty, then fewer blocks.
    """
    train, valid = sums
    judge = valid if valid[0, 0] > 0 else train
    best = None
    for penalty in sorted(penalties, reverse=True):
        forecasts, backcasts = stack_blocks(train, inputs, widths, penalty)
        weights = np.zeros_like(forecasts[0])
        last = np.inf
        for count, forecast in enumerate(forecasts, 1):
            weights = weights + forecast
            error = _error(judge, weights, inputs)
            if error >= last:
                break
            last = error
            if best is None or error < best.valid_error:
                best = Stack(weights, forecasts[:count], backcasts[:count], penalty, count, _error(train, weights, inputs), error)
    return best


def fit_windows(
    scaled: DataFrame, lookback: int, steps: int, spec: Spec, share: float | None, widths: Sequence[int], penalties: Sequence[float]
) -> Stack | None:
    """The stack for ``scaled`` (series_id, pos, n, z); None without a single sample."""
    sums = _matrices(window_sums(scaled, lookback, steps, spec, share), 1 + lookback + steps)
    return fit_stack(sums, 1 + lookback, widths, penalties) if sums[0, 0, 0] > 0 else None


def _newest(scaled: DataFrame, lookback: int, *keep: str) -> DataFrame:
    rows = scaled.where(F.col("pos") >= F.col("n") - lookback)
    past = F.sort_array(F.collect_list(F.struct("pos", "z")))
    window = F.transform(past, lambda r: r["z"])
    return rows.groupBy("series_id", *keep).agg(window.alias("window"), F.max("ts").alias("_last"))


def stacked_horizon(
    regular: DataFrame,
    spec: Spec,
    steps: int | None = None,
    *,
    lookback: int | None = None,
    widths: Sequence[int] = BLOCKS,
    penalties: Sequence[float] = PENALTIES,
    share: float | None = 0.8,
    scaler_share: float | None = None,
    model: str = "stacked_horizon",
) -> DataFrame:
    """Forecast all steps at once by stacked blocks, pooled over series.

    Every origin with a whole lookback (by default three seasons or the horizon, if longer) and horizon is a sample. The
    first ``share`` of each series' samples fits, the rest chooses the penalty and the number of
    blocks; None fits and judges on all. Values are scaled per series, by all rows or the first
    ``scaler_share``. A series with less than a lookback gets the K-day average, named in
    ``model_used``; so does every series when no series has a sample.
    """
    steps = spec.horizon if steps is None else steps
    lookback = max(3 * spec.period, steps) if lookback is None else lookback
    table = regular.select("series_id", "ts", "pos", "n", "value")
    scaler = minmax_fit(table, ["value"], scaler_share)
    scaled = minmax_transform(table, scaler, ["value"], spec.chunk).withColumnRenamed("value", "z")
    scaled = saved(scaled.select("series_id", "ts", "pos", "n", "z", "value_min", "value_max"))
    stack = fit_windows(scaled, lookback, steps, spec, share, widths, penalties)
    if stack is None:
        return seasonal_naive(regular, spec, steps, k=spec.k_days).withColumn("model", F.lit(model))
    weights = stack.weights
    state = _newest(scaled.where(F.col("n") >= lookback), lookback, "value_min", "value_max")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column("window").to_pylist())
                ahead = weights[0] + x @ weights[1:]
                keep = [batch.column(c) for c in ("series_id", "_last", "value_min", "value_max")]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array(ahead.tolist(), pa.list_(pa.float64()))], names=["series_id", "_last", "value_min", "value_max", "ahead"]
                )

    key = regular.schema["series_id"].dataType.simpleString()
    told = state.select("series_id", "_last", "value_min", "value_max", "window").mapInArrow(
        answer, f"series_id {key}, _last timestamp_ntz, value_min double, value_max double, ahead array<double>"
    )
    rolled = told.select("series_id", "_last", "value_min", "value_max", F.posexplode("ahead").alias("i", "z"))
    found = _forecast(rolled, F.col("z") * (F.col("value_max") - F.col("value_min")) + F.col("value_min"), spec, model)
    rest = seasonal_naive(regular.where(F.col("n") < lookback), spec, steps, k=spec.k_days).withColumn("model", F.lit(model))
    return found.unionByName(rest)


def _forecast(rolled: DataFrame, yhat: Column, spec: Spec, model: str) -> DataFrame:
    h = (F.col("i") + 1).cast("int")
    return rolled.select(
        "series_id", F.lit(model).alias("model"), h.alias("h"), shift("_last", h, spec.step).alias("ts"),
        yhat.alias("yhat"), F.lit(model).alias("model_used"),
    )
