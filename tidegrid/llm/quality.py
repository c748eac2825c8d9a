"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are counted on the executors, on byte arrays. The trees are fitted on the
driver from at most FIT_ROWS labelled rows of statistics (numbers only, no text): features become
bins by quantiles, gradients and Hessians are summed per bin, and the best split of every leaf is
read from the sums. Fitted trees are flat arrays, walked by all rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import saved, where_text
from tidegrid.llm.textarrays import slices, text_buffers, word_hashes

#: Labelled rows that the trees are fitted on, those with the smallest hash of their id.
FIT_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_HESSIAN = 60, 4, 64, 0.2, 1.0, 2.0
CUT = 0.3

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "line_words", "sentence_words",
    "upper", "letter", "digit", "space", "mark", "other_mark", "non_ascii", "comma", "stop",
    "upper_words", "marked_words", "long_words", "short_words", "distinct_words", "distinct_pairs",
    "distinct_lines", "top_word", "longest_word", "bar", "bang", "mark_runs", "bullet_lines",
)

_KINDS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": [32, *range(9, 14)],
    "comma": [44, 59], "stop": [46, 63], "bang": [33], "bar": [124], "newline": [10], "non_ascii": range(128, 256),
}
_KINDS["mark"] = [b for b in range(33, 127) if not chr(b).isalnum()]
_KINDS["other_mark"] = [b for b in _KINDS["mark"] if chr(b) not in ".,;:?!'\"()-"]
_TABLES = {k: np.isin(np.arange(256), list(v)) for k, v in _KINDS.items()}


def statistics(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, features) statistics of a slice of texts."""
    n = len(off) - 1
    lo, hi = int(off[0]), int(off[-1])
    data, rows = raw[lo:hi], off - lo
    size = np.diff(rows).astype(float)
    out = np.zeros((n, len(FEATURES)), np.float32)
    if not len(data):
        return out
    one = np.maximum(size, 1)

    def per_row(flags, edges=rows):
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[edges[1:]] - sums[edges[:-1]]).astype(float)

    count = {k: per_row(t[data]) for k, t in _TABLES.items()}
    words, n_words, starts, ends = word_hashes(raw, off)
    starts, ends = starts - lo, ends - lo
    edges = np.concatenate([[0], np.cumsum(n_words)])
    width = ends - starts
    some = np.maximum(n_words, 1).astype(float)
    row = np.repeat(np.arange(n), n_words)

    def in_words(table):
        sums = np.concatenate([[0], np.cumsum(_TABLES[table][data], dtype=np.int64)])
        return sums[ends] - sums[starts]

    upper, lower, marks = in_words("upper"), in_words("lower"), in_words("other_mark")

    def distinct(values, owner):
        """Number of distinct values per row and the largest share of one."""
        if not len(values):
            return np.zeros(n), np.zeros(n)
        order = np.lexsort((values, owner))
        v, o = values[order], owner[order]
        new = np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])])
        first = np.flatnonzero(new)
        runs = np.diff(np.concatenate([first, [len(v)]]))
        most = np.zeros(n)
        np.maximum.at(most, o[first], runs)
        return np.bincount(o[first], minlength=n).astype(float), most

    kinds, top = distinct(words, row)
    same = row[1:] == row[:-1]
    pairs, _ = distinct((words[:-1] * np.uint64(31) + words[1:])[same], row[1:][same])
    # lines: hashes of their words in order
    newline = np.concatenate([[0], np.cumsum(_TABLES["newline"][data], dtype=np.int64)])
    lines = count["newline"] + 1
    line = newline[starts]
    begin = np.concatenate([[True], (line[1:] != line[:-1]) | (row[1:] != row[:-1])]) if len(words) else np.zeros(0, bool)
    at = np.flatnonzero(begin)
    place = (np.arange(len(words)) - np.repeat(at, np.diff(np.concatenate([at, [len(words)]])))).astype(np.uint64)
    line_hash = np.add.reduceat(words * (place * np.uint64(2) + np.uint64(1)), at) if len(at) else np.zeros(0, np.uint64)
    line_kinds, _ = distinct(line_hash, row[at])
    full_lines = np.bincount(row[at], minlength=n).astype(float)
    bullets = np.bincount(row[at], weights=np.isin(data[starts[at]], [42, 43, 45]), minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, row, width)
    mark = _TABLES["mark"][data]
    runs = per_row(np.concatenate([[False], mark[1:] & mark[:-1]]))
    by_row = lambda flags: np.bincount(row, weights=flags, minlength=n) / some
    columns = (
        np.log1p(size), np.log1p(n_words), np.log1p(lines), np.bincount(row, weights=width, minlength=n) / some,
        n_words / np.maximum(full_lines, 1), n_words / (count["stop"] + count["bang"] + 1),
        count["upper"] / one, (count["upper"] + count["lower"]) / one, count["digit"] / one, count["space"] / one,
        count["mark"] / one, count["other_mark"] / one, count["non_ascii"] / one, count["comma"] / some,
        count["stop"] / some, by_row((upper > 1) & (lower == 0)), by_row(marks > 0), by_row(width > 15),
        by_row(width < 3), kinds / some, pairs / some, line_kinds / np.maximum(full_lines, 1), top / some,
        np.log1p(longest), count["bar"] / some, count["bang"] / some, runs / some, bullets / np.maximum(full_lines, 1),
    )
    for k, c in enumerate(columns):
        out[:, k] = c
    return out


@dataclass
class Trees:
    """Flat trees: node k of tree t has a feature (-1 in a leaf), a threshold, a left child (right: +1) and a value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; every step moves all rows of the batch one level down a tree."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, left, value in zip(self.feature, self.threshold, self.left, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] > threshold[node]
                node = np.where(inner, left[node] + right, node)
            total += value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees on logistic loss. With no rows, or one label only, the prior alone is left."""
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.full((TREES, nodes), -1, np.int64)
    threshold, value = np.zeros((TREES, nodes), np.float32), np.zeros((TREES, nodes))
    left = np.zeros((TREES, nodes), np.int64)
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    trees = Trees(feature, threshold, left, value, float(np.log(rate / (1 - rate))))
    if not len(y) or y.min() == y.max():
        return trees
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    flat = binned + np.arange(x.shape[1]) * BINS
    total = np.full(len(y), trees.base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node, free = np.zeros(len(y), np.int64), 1
        level = [0]
        for _ in range(DEPTH):
            deeper = []
            for k in level:
                own = np.flatnonzero(node == k)
                where = flat[own].ravel()
                each = x.shape[1]
                gs = np.bincount(where, np.repeat(g[own], each), BINS * each).reshape(each, BINS).cumsum(1)
                hs = np.bincount(where, np.repeat(h[own], each), BINS * each).reshape(each, BINS).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hs < LEAST_HESSIAN) | (ht - hs < LEAST_HESSIAN)] = 0
                f, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[f, b] <= 1e-6 or b >= len(cuts[f]):
                    continue
                feature[t, k], threshold[t, k], left[t, k] = f, cuts[f][b], free
                node[own] = free + (binned[own, f] > b)
                deeper += [free, free + 1]
                free += 2
            level = deeper
        gs, hs = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
        value[t] = -RATE * gs / (hs + RIDGE)
        total += value[t][node]
    return trees


def held_out(remainders: int, which: int):
    """Whether crc32 of the id's text leaves ``which`` modulo ``remainders``; a null id counts as empty text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % remainders == which


def _per_slice(docs: DataFrame, values, fields: list[tuple[str, str]]) -> DataFrame:
    """doc_id and, for each row's text, the columns that ``values`` makes of its statistics."""
    kinds = {"float": pa.float32(), "double": pa.float64(), "int": pa.int32()}
    schema = pa.schema([("doc_id", pa.int64()), *((f, kinds[k]) for f, k in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            ids = batch.column("doc_id").cast(pa.int64())
            for first, last in slices(off):
                cols = values(statistics(raw, off[first : last + 1]))
                arrays = [pa.array(np.ascontiguousarray(c)) for c in cols]
                yield pa.RecordBatch.from_arrays([ids[first:last], *arrays], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{f} {k}" for f, k in fields))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each row's text; null counts as empty."""
    return _per_slice(docs, lambda x: list(x.T), [(f, "float") for f in FEATURES])


def labelled(docs: DataFrame, labels: DataFrame, label: str, remainders: int, which: int, most: int) -> DataFrame:
    """At most ``most`` rows (doc_id, text, y) to learn from: labelled, not held out, smallest id hash first.

    Only labels 0 and 1 count; an id with several labels counts by its largest.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(remainders, which))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most ``most`` ids; of rows that repeat one, the smallest text counts
    return rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Trees:
    """Fit on the labelled rows that are not held out; only their statistics reach the driver."""
    rows = saved(labelled(docs, labels, "quality", 5, 0, most))
    found = with_statistics(rows).toPandas().sort_values("doc_id")
    y = rows.select("doc_id", "y").toPandas().set_index("doc_id")["y"].reindex(found["doc_id"])
    return fit(found[list(FEATURES)].to_numpy(np.float32), y.to_numpy(float))


def scored(docs: DataFrame, trees: Trees) -> DataFrame:
    """Score of every text: doc_id, held_out, score, predicted.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null text counts as empty and
    gets the score of one. Rows are independent, so repeated rows get equal scores; a null doc_id
    is kept. Very long texts are scored whole. An empty table stays empty. Without usable labels every score is one half.
    """
    out = _per_slice(docs, lambda x: [trees.scores(x)], [("score", "double")])
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def good(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of ``docs`` that the trees do not reject, with their columns; nothing is shuffled."""

    def passed(text: pa.Array) -> np.ndarray:
        raw, off = text_buffers(text)
        return np.concatenate([np.zeros(0, bool), *(trees.scores(statistics(raw, off[a : b + 1])) >= CUT for a, b in slices(off))])

    return where_text(docs, passed)
