"""A non-linear recursive forecaster: boosted trees grown on the cluster.

One model for all series predicts the next value from the whole lookback, the slot of the season,
the weekend and covariates of the row before, and is rolled out one step at a time.

Samples are never laid out. A series is cut into stretches, one row with the values of a stretch and
the lookback before it; a task slides a window over that array. Values are binned by their place
between a series' smallest and largest. For each level of a tree a task adds up what is left to
explain by (node, feature, bin), Spark adds these histograms up over all tasks, and the driver picks
the splits from histograms whose size depends on the model only. What is left to explain is held in
whole numbers, so sums are the same in any order and the same splits come out on every run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.calendar import is_weekend
from tidegrid.functions.timegrid import shift
from tidegrid.operators.baseline import seasonal_naive
from tidegrid.operators.scaling import minmax_fit, minmax_transform
from tidegrid.session import saved
from tidegrid.spec import Spec

#: Bins of a feature, and units of a scaled value of 1.
BINS, UNITS = 32, 1 << 24
#: Trees after which the rest to explain is written down anew; later trees are applied on the fly.
WRITE_EVERY = 5


@dataclass
class Tree:
    """Nodes in level order: ``2 i + 1`` and ``2 i + 2`` follow node ``i``; feature -1 is a leaf."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    value: list[int] = field(default_factory=list)

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        """Node of every row of a matrix of bins; rows that go on further than the tree stay at its edge."""
        at = np.zeros(len(bins), np.int64)
        feature, cut = np.array(self.feature), np.array(self.bin)
        rows = np.arange(len(bins))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            right = bins[rows, np.maximum(f, 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)


@dataclass
class Boosted:
    """``base`` and leaf values in units; ``errors`` are validation mean squares after 0, 1, ... trees."""

    base: int
    trees: list[Tree]
    errors: list[float]

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base, np.int64)
        for t in self.trees:
            out += np.array(t.value)[t.leaf(bins)]
        return out / UNITS


def to_bins(z: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(z * BINS), 0, BINS - 1).astype(np.uint8)


def _calendar(ts: Column | str, spec: Spec) -> Column:
    """Bins of what is known of a stamp: place in the day, weekend."""
    second = F.unix_seconds(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))
    place = F.floor(F.pmod(second, F.lit(86400)) * BINS / 86400).cast("int")
    stamp = F.col(ts) if isinstance(ts, str) else ts
    return F.array(place, F.when(is_weekend(stamp), BINS - 1).otherwise(0))


def stretches(scaled: DataFrame, lookback: int, exog_cols: Sequence[str], spec: Spec, share: float | None) -> DataFrame:
    """One row per stretch: its values ``z`` from ``lookback`` rows before on, and what goes with them.

    ``skip`` is how many of the rows have no whole lookback in ``z``, ``train`` how many of the samples
    train (the first ``share`` of a series), ``rest`` what is left to explain, in units.
    """
    span = max(spec.chunk, 4 * lookback)
    home = F.floor(F.col("pos") / F.lit(span))
    last = F.floor(F.least(F.col("pos") + F.lit(lookback), F.col("n") - 1) / F.lit(span))
    row = F.struct("pos", "z", _calendar("ts", spec).alias("now"), F.array(*exog_cols).cast("array<double>").alias("prev"))
    dealt = scaled.select("series_id", "n", row.alias("r"), F.sequence(home, last).alias("chunks"))
    dealt = dealt.select("series_id", "n", "r", F.explode("chunks").alias("chunk"))
    rows = dealt.groupBy("series_id", "n", "chunk").agg(F.sort_array(F.collect_list("r")).alias("r"))
    first = F.greatest(F.col("chunk") * span, F.lit(lookback))
    samples = F.col("n") - lookback
    train = samples if share is None else F.floor(F.lit(share) * samples)

    def part(name: str) -> Column:
        return F.transform("r", lambda x: x[name])

    z = part("z")
    skip = (first - F.col("r")[0]["pos"]).cast("int")
    rest = F.transform(F.slice(z, skip + 1, F.greatest(F.size("r") - skip, F.lit(0))), lambda v: F.round(v * UNITS).cast("bigint"))
    return rows.where(skip < F.size("r")).select(
        z.alias("z"), F.flatten(part("now")).alias("now"), F.flatten(part("prev")).alias("prev"), skip.alias("skip"),
        (train - (first - lookback)).cast("bigint").alias("train"), rest.alias("rest"),
    )


def _sample_bins(z: np.ndarray, now: np.ndarray, prev: np.ndarray, skip: int, lookback: int) -> np.ndarray:
    """Bins of the samples of a stretch: lags 1, 2, ..., the calendar of the row, covariates of the row before."""
    binned = to_bins(np.nan_to_num(z))
    windows = np.lib.stride_tricks.sliding_window_view(binned, lookback)[skip - lookback : len(z) - lookback, ::-1]
    return np.concatenate([windows, now[skip:].astype(np.uint8), to_bins(np.nan_to_num(prev[skip - 1 : len(z) - 1]))], axis=1)


def _stretch_arrays(batch: pa.RecordBatch, lookback: int, n_exog: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bins, rest, number of training samples) of every stretch."""
    for r in batch.to_pylist():
        z = np.array(r["z"], float)
        now = np.array(r["now"]).reshape(len(z), -1)
        prev = np.array(r["prev"], float).reshape(len(z), n_exog)
        rest = np.array(r["rest"], np.int64)
        yield _sample_bins(z, now, prev, r["skip"], lookback), rest, min(max(r["train"], 0), len(rest))


def _histograms(table: DataFrame, pending: list[Tree], tree: Tree, level: int, lookback: int, n_exog: int) -> DataFrame:
    """Rows, sum to explain by (node, feature, bin) of the nodes of a level, over training samples.

    Node -1 holds the number of validation samples and the sum of squares left there.
    """
    width = lookback + 2 + n_exog
    first, nodes = 2**level - 1, 2**level
    schema = pa.schema([("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("rows", pa.int64()), ("total", pa.int64()), ("squares", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = np.zeros(nodes * width * BINS, np.int64), np.zeros(nodes * width * BINS)
        judged, squares = 0, 0.0
        for batch in batches:
            for bins, rest, train in _stretch_arrays(batch, lookback, n_exog):
                for done in pending:
                    rest = rest - np.array(done.value)[done.leaf(bins)]
                judged += len(rest) - train
                squares += float(np.sum((rest[train:] / UNITS) ** 2))
                bins, rest = bins[:train], rest[:train]
                node = tree.leaf(bins) - first if tree.feature else np.zeros(train, np.int64)
                here = node >= 0
                bins, rest, node = bins[here], rest[here], node[here]
                key = ((node[:, None] * width + np.arange(width)) * BINS + bins).ravel()
                rows += np.bincount(key, minlength=len(rows))
                total += np.bincount(key, weights=np.repeat(rest.astype(float), width), minlength=len(rows))
        at = np.flatnonzero(rows)
        keys = [np.append(-1, k).astype(np.int32) for k in (at // BINS // width, at // BINS % width, at % BINS)]
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, keys), pa.array(np.append(judged, rows[at])), pa.array(np.append(0, total[at].astype(np.int64))),
             pa.array(np.append(squares, np.zeros(len(at))))], schema=schema,
        )

    parts = table.mapInArrow(run, "node int, feature int, bin int, rows bigint, total bigint, squares double")
    return parts.groupBy("node", "feature", "bin").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))


def best_splits(rows: np.ndarray, total: np.ndarray, penalty: float, least: int) -> list[tuple[int, int] | None]:
    """(feature, last bin to the left) of every node from its histograms (nodes x features x bins).

    The split with the largest gain; ties take the first feature, then the first bin. None when no
    split leaves ``least`` rows on both sides or none gains.
    """
    out = []
    for n, g in zip(rows, total):
        left_n, left_g = np.cumsum(n, axis=1)[:, :-1], np.cumsum(g, axis=1)[:, :-1]
        all_n, all_g = n.sum(axis=1)[:, None], g.sum(axis=1)[:, None]
        with np.errstate(invalid="ignore", divide="ignore"):  # empty sides are ruled out below
            gain = left_g.astype(float) ** 2 / (left_n + penalty) - all_g.astype(float) ** 2 / (all_n + penalty)
            gain += (all_g - left_g).astype(float) ** 2 / (all_n - left_n + penalty)
        gain = np.where((left_n >= least) & (all_n - left_n >= least), gain, 0.0)
        at = int(np.argmax(gain))
        out.append(divmod(at, gain.shape[1]) if gain.ravel()[at] > 0 else None)
    return out


def leaf_value(total: int, rows: int, rate: float, penalty: float) -> int:
    return int(np.rint(rate * total / (rows + penalty))) if rows else 0


def _grow(table, pending, lookback, n_exog, depth, rate, penalty, least) -> tuple[Tree, float | None, int]:
    """One tree; also the validation mean square before it, and the number of training samples."""
    width = lookback + 2 + n_exog
    tree, error, count = Tree(), None, 0
    sums: list[tuple[int, int]] = []  # rows and total of every node
    for level in range(depth):
        nodes = 2**level
        rows = np.zeros((nodes, width, BINS), np.int64)
        total = np.zeros((nodes, width, BINS), np.int64)
        for r in _histograms(table, pending, tree, level, lookback, n_exog).collect():
            if r["node"] >= 0:
                rows[r["node"], r["feature"], r["bin"]], total[r["node"], r["feature"], r["bin"]] = r["rows"], r["total"]
            elif level == 0 and r["rows"]:
                error = r["squares"] / r["rows"]
        if level == 0:
            count = int(rows[0, 0].sum())
            sums = [(count, int(total[0, 0].sum()))]
            tree = Tree([-1], [0], [leaf_value(sums[0][1], sums[0][0], rate, penalty)])
        splits = best_splits(rows, total, penalty, least)
        if not any(splits):
            break
        first = nodes - 1
        below = []
        for k, split in enumerate(splits):
            if split is None:
                below += [(0, 0), (0, 0)]
                continue
            f, b = split
            tree.feature[first + k], tree.bin[first + k] = f, b
            left = (int(rows[k, f, : b + 1].sum()), int(total[k, f, : b + 1].sum()))
            below += [left, (int(rows[k, f].sum()) - left[0], int(total[k, f].sum()) - left[1])]
        tree.feature += [-1] * len(below)
        tree.bin += [0] * len(below)
        tree.value += [leaf_value(g, n, rate, penalty) for n, g in below]
    return tree, error, count


def _explained(table: DataFrame, pending: list[Tree], lookback: int, n_exog: int) -> DataFrame:
    """The stretches with what the pending trees leave to explain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rests = []
            for bins, rest, _ in _stretch_arrays(batch, lookback, n_exog):
                for done in pending:
                    rest = rest - np.array(done.value)[done.leaf(bins)]
                rests.append(rest.tolist())
            place = batch.schema.get_field_index("rest")
            yield batch.set_column(place, batch.schema.field(place), pa.array(rests, batch.schema.field(place).type))

    return table.mapInArrow(run, table.schema)


def fit_boosted(
    table: DataFrame, lookback: int, n_exog: int, *, trees: int = 20, depth: int = 3, rate: float = 0.3, penalty: float = 1.0,
    least: int = 20, patience: int = 3,
) -> Boosted | None:
    """Grow trees until ``trees`` or until ``patience`` of them do not lower the validation error.

    Without validation samples all trees are kept. None when there is no training sample.
    """
    mean = Tree([-1], [0], [0])
    table = saved(table)
    root, _, count = _grow(table, [], lookback, n_exog, 1, 1.0, 0.0, 1 << 62)
    if not count:
        return None
    mean.value = root.value
    model, pending = Boosted(root.value[0], [], []), [mean]
    while True:
        tree, error, _ = _grow(table, pending, lookback, n_exog, depth, rate, penalty, least)
        model.errors.append(error if error is not None else 0.0)
        best = int(np.argmin(model.errors))
        if error is not None and len(model.errors) - 1 - best >= patience:
            break
        if len(model.trees) == trees or tree.feature == [-1]:
            break
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) >= WRITE_EVERY:
            table, pending = saved(_explained(table, pending, lookback, n_exog)), []
    if error is not None:
        model.trees = model.trees[: int(np.argmin(model.errors))]
    return model


def boosted_recursive(
    regular: DataFrame,
    spec: Spec,
    steps: int | None = None,
    *,
    lookback: int | None = None,
    exog_cols: Sequence[str] = (),
    share: float | None = 0.8,
    model: str = "boosted_recursive",
    **grown: float,
) -> DataFrame:
    """One boosted model for all series, predicting one step at a time from the whole lookback.

    All samples of all series count: the first ``share`` of each series trains, the rest decides when
    to stop (None: all train). Values are scaled per series by its range. ``exog_cols`` are columns
    of ``regular``; their values of the row before are features, and stay at the last ones in the
    rollout, while slot and weekend follow the calendar. ``grown`` goes to ``fit_boosted``. A series
    with less than a lookback (three seasons by default) gets the K-day average, named in ``model_used``.
    """
    steps = spec.horizon if steps is None else steps
    lookback = 3 * spec.period if lookback is None else lookback
    cols = ["value", *exog_cols]
    table = regular.select("series_id", "ts", "pos", "n", *cols)
    scaled = minmax_transform(table, minmax_fit(table, cols), cols, spec.chunk).withColumnRenamed("value", "z")
    keep = ["series_id", "ts", "pos", "n", "z", *exog_cols, "value_min", "value_max"]
    scaled = saved(scaled.where(F.col("n") >= lookback).select(*keep))
    found = fit_boosted(stretches(scaled.where(F.col("n") > lookback), lookback, exog_cols, spec, share), lookback, len(exog_cols), **grown)
    if found is None:
        return seasonal_naive(regular, spec, steps, k=spec.k_days).withColumn("model", F.lit(model))
    rows = F.sort_array(F.collect_list(F.struct("pos", "z", F.array(*exog_cols).cast("array<double>").alias("x"))))
    state = scaled.where(F.col("pos") >= F.col("n") - lookback).groupBy("series_id", "value_min", "value_max").agg(
        F.max("ts").alias("_last"), rows.alias("r")
    )
    ahead = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda h: _calendar(shift("_last", h, spec.step), spec)))
    fed = state.select(
        "series_id", "_last", "value_min", "value_max", F.transform("r", lambda r: r["z"]).alias("z"), F.element_at("r", -1)["x"].alias("x"), ahead.alias("now")
    )
    names = ["series_id", "_last", "value_min", "value_max"]

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            path = np.concatenate([np.array(batch.column("z").to_pylist(), float), np.zeros((size, steps))], axis=1)
            prev = to_bins(np.nan_to_num(np.array(batch.column("x").to_pylist(), float).reshape(size, -1)))
            now = np.array(batch.column("now").to_pylist(), np.uint8).reshape(size, steps, -1)
            for h in range(steps):
                lags = to_bins(np.nan_to_num(path[:, h : h + lookback]))[:, ::-1]
                path[:, lookback + h] = found.predict(np.concatenate([lags, now[:, h], prev], axis=1))
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(path[:, lookback:].tolist(), pa.list_(pa.float64()))], names=[*names, "ahead"]
            )

    key = regular.schema["series_id"].dataType.simpleString()
    told = fed.mapInArrow(roll, f"series_id {key}, _last timestamp_ntz, value_min double, value_max double, ahead array<double>")
    rolled = told.select(*names, F.posexplode("ahead").alias("i", "z"))
    h = (F.col("i") + 1).cast("int")
    out = rolled.select(
        "series_id", F.lit(model).alias("model"), h.alias("h"), shift("_last", h, spec.step).alias("ts"),
        (F.col("z") * (F.col("value_max") - F.col("value_min")) + F.col("value_min")).alias("yhat"), F.lit(model).alias("model_used"),
    )
    rest = seasonal_naive(regular.where(F.col("n") < lookback), spec, steps, k=spec.k_days).withColumn("model", F.lit(model))
    return out.unionByName(rest)
