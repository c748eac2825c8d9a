"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on what sets toxic text apart (the
toxic documents without the words that ordinary documents use as often). Every text is cut into
windows of a few words, and each window is compressed against the ordinary dictionary and against
the ordinary one with the toxic one laid on top. What the toxic dictionary saves, in bytes, is the
window's margin. Ordinary windows with the largest margins go into the ordinary dictionary, and
both are built again. A logistic curve over the margins of a text, fitted on labelled documents
that the dictionaries have not seen, calibrates the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import saved
from tidegrid.llm.quality import held_out

#: Labelled documents to learn from: at most so many of either label, smallest hash of the id first.
FIT_TOXIC, FIT_ORDINARY = 6_000, 12_000
#: Words that can stand for toxic text, ordinary windows for the ordinary dictionary.
TOXIC_WORDS, ORDINARY_WINDOWS, HARD_WINDOWS, ROUNDS = 2_000, 20_000, 1_200, 3
TOXIC_BYTES, ORDINARY_BYTES, HARD_BYTES = 4_096, 65_536, 65_536
WINDOW_BYTES = 48
CUT = 0.3
FEATURES = 8
#: Stands before every window and in both dictionaries, so that no window is stored uncompressed.
MARK = b"~~~~ marker ~~~~"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def windows(text: str | None) -> list[bytes]:
    """Runs of whole lower-case words of about WINDOW_BYTES; neighbours share a word."""
    letters = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    line = b" " + letters.encode() + b" "
    out, start, last = [], 0, len(line) - 1 if letters else 0
    while start < last:
        end = line.find(b" ", min(start + WINDOW_BYTES, last))
        out.append(line[start : end + 1])
        if end >= last:
            break
        again = line.rfind(b" ", start, end)
        start = again if again > start else end
    return out


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; of samples too few to train on, the samples themselves."""
    try:
        whole = zstandard.train_dictionary(size + 256, samples).as_bytes()
        return whole[-size:] if len(whole) > size else whole[256:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Search tables are large enough for the whole dictionary, so its length shifts no matches."""
    settings = zstandard.ZstdCompressionParameters(
        window_log=19, chain_log=19, hash_log=18, search_log=7, min_match=6, target_length=16,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    data = zstandard.ZstdCompressionDict(content + MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=settings)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()

    def margins(self, text: str | None) -> np.ndarray:
        plain, both = _compressors(self)
        return np.array([len(plain.compress(MARK + w)) - len(both.compress(MARK + w)) for w in windows(text)], np.int64)


_built: dict[Model, tuple] = {}


def _compressors(model: Model) -> tuple:
    """A worker builds the search tables of a model once."""
    if model not in _built:
        _built.clear()
        _built[model] = compressor(model.ordinary), compressor(model.ordinary + model.toxic)
    return _built[model]


def features(margins: np.ndarray) -> tuple[float, ...]:
    """What the margins of a text say; the same for texts without windows as for one empty window."""
    n = max(len(margins), 1)
    top = np.sort(np.append(margins, [0, 0]))[::-1]
    hits = float(np.log1p((margins >= 3).sum()))
    return (1.0, float(top[0]), float(top[0] + top[1]), hits, hits - np.log(n), np.log(n),
            max(top[0] - 4.0, 0.0), max(top[0] - 6.0, 0.0))


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method, slightly shrunk."""
    w = np.zeros(FEATURES)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(FEATURES), x.T @ (y - p) - w)
        w = w + step
    return tuple(map(float, w))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, y, text, seen): the labelled documents to learn from; four fifths are for the dictionaries."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(4, 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("y"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.where("y = 1").orderBy(*order).limit(FIT_TOXIC).union(
        known.where("y = 0").orderBy(*order).limit(FIT_ORDINARY)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # of rows that repeat an id the smallest text counts
    return (
        rows.join(F.broadcast(some), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min("text").alias("text"))
        .withColumn("seen", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)) > 0)
    )


def _toxic_samples(seen: DataFrame) -> list[bytes]:
    """What sets toxic documents apart: their words with a clearly higher share, by document.

    A word counts when its share of toxic documents, less 1.5 standard errors, is over three times
    its share of ordinary ones, plus as much.
    """
    n = {r["y"]: r["n"] for r in seen.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(1):
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    counts = (
        seen.select("y", F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"))
    )
    low = (F.col("t") - 1.5 * F.sqrt("t")) / n[1]
    high = (F.col("o") + 1.5 * F.sqrt("o") + 0.3) / max(n.get(0, 0), 1)
    found = (
        counts.where((F.col("t") >= min(4, n[1])) & (low > 3 * high))
        .orderBy((low / high).desc(), "word")
        .limit(TOXIC_WORDS)
        .toPandas()
    )
    # as many samples as the commonest word has documents, at most a thousand; a word is in its share
    scale = max(1.0, found["t"].max() / 1000) if len(found) else 1.0
    often = [(w, max(1, int(t / scale))) for w, t in zip(found["word"], found["t"])]
    rows: list[list[str]] = [[] for _ in range(max((t for _, t in often), default=0))]
    for k, (w, t) in enumerate(often):
        for i in range(t):
            rows[(i * 7 + k) % len(rows)].append(w)
    return [f" {' '.join(r)} ".encode() for r in rows if r]


def _ordinary_windows(seen: DataFrame, model: Model | None) -> list[bytes]:
    """Windows of ordinary documents: the HARD_WINDOWS with the largest margins, or some by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                own = windows(text)
                margins = model.margins(text) if model else np.zeros(len(own), np.int64)
                keep = [k for k in range(len(own)) if model is None or margins[k] >= 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own[k] for k in keep], pa.binary()), pa.array(margins[keep].tolist(), pa.int64())],
                    names=["w", "margin"],
                )

    found = seen.where("y = 0").select("text").mapInArrow(run, "w binary, margin bigint").groupBy("w").agg(
        F.max("margin").alias("margin")
    )
    most = HARD_WINDOWS if model else ORDINARY_WINDOWS
    rows = found.orderBy(F.col("margin").desc(), F.xxhash64("w"), "w").limit(most).toPandas()
    return [bytes(w) for w in rows["w"]]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Dictionaries and calibration from a bounded sample of the labelled rows that are not held out."""
    rows = saved(_sample(docs, labels))
    seen = rows.where("seen")
    samples = _toxic_samples(seen)
    plain = trained(_ordinary_windows(seen, None), ORDINARY_BYTES)
    # repeated, for training wants many times the size of what it makes
    toxic = trained(samples * max(1, 200_000 // max(1, sum(map(len, samples)))), TOXIC_BYTES) if samples else b""
    model = Model(plain, toxic)
    hard = b""
    for _ in range(ROUNDS if toxic else 0):
        hard = (b"".join(reversed(_ordinary_windows(seen, model))) + hard)[-HARD_BYTES:]
        model = Model(plain + hard, toxic)
    rest = measured(rows.where("not seen"), model).join(rows.select("doc_id", "y"), "doc_id").orderBy("doc_id").toPandas()
    if not len(rest):
        return Model(model.ordinary, toxic, (0.0,) * FEATURES)
    x = np.array(rest["features"].tolist(), float).reshape(len(rest), FEATURES)
    return Model(model.ordinary, toxic, _calibrated(x, rest["y"].to_numpy(float)))


def measured(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, number of windows, largest margin and features of every text; null counts as empty."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_windows", pa.int64()), ("margin", pa.int64()), ("features", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [model.margins(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(m) for m in margins], pa.int64()),
                    pa.array([int(max(m, default=0)) for m in margins], pa.int64()),
                    pa.array([features(m) for m in margins], pa.list_(pa.float64())),
                ],
                schema=schema,
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_windows bigint, margin bigint, features array<double>")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Score of every text: doc_id, held_out, score, predicted, n_windows, margin.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Null, empty and letterless
    texts have no windows and share one low score. Rows are independent: repeated rows get equal
    scores and a null doc_id is kept. Very long texts are scored whole, by all their windows. An empty table stays empty. Without labelled documents every
    score is one half; without toxic ones no window has a margin.
    """
    total = sum((F.col("features")[k] * w for k, w in enumerate(model.weights)), F.lit(0.0))
    score = 1 / (1 + F.exp(-total))
    return measured(docs, model).select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        score.alias("score"),
        (score >= CUT).cast("int").alias("predicted"),
        "n_windows",
        "margin",
    )
