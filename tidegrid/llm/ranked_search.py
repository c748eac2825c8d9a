"""Ranked search of benchmark items in documents by dense matrix products.

Items are packed into tiles of at most TILE_ITEMS items. A tile has a compact vocabulary, the terms
of its own items, and a matrix ``items x terms`` of how often an item asks for a term, times the
term's weight. A block of documents gives a matrix ``terms x documents`` of impacts. Their product
in float64 holds the scores of all items of the tile in all documents of the block. Everything is
a whole number; the vocabulary is cut where the scores of a part could reach 2^53, so every product
is exact, and parts add up in 64-bit integers.

Each task keeps the best documents of every item: scores that reach an item's current k-th best are
merged by (score, smallest doc_id), so ties are never lost. The winners of all tasks meet by item
and salt, then by item.

Items come in rounds of at most ROUND_BYTES. A round reads the documents once and writes for each
the round's terms it holds; the corpus statistics and the scores both come from that table. The
driver and every task hold one round's items, never the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.llm.common import saved, written

#: Results per item.
TOP = 10
#: Items of a tile, and documents of a block.
TILE_ITEMS, BLOCK_DOCS = 32, 512
#: Cells of a block of documents for one tile: wide vocabularies take fewer documents at a time.
BLOCK_CELLS = 1 << 20
#: Bytes of item texts that one round brings to the driver and the tasks.
ROUND_BYTES = 16 << 20
#: Sums of a product stay below this.
EXACT = 1 << 53
#: Parts in which an item's winners are merged first.
SALTS = 32

# Fixed values of the score: impact scale, saturation, share of the length.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 75
#: The largest impact before the weight: 10^9 tf div (1000 tf + 8 m) stays below a million.
MOST_IMPACT = SCALE // 1000
_TERM = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum())
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _TERM else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and all non-ASCII characters, with A-Z as a-z."""
    return text.translate(_FOLD).split()


def _item_rounds(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items, some at a time, each as (item_id, how often it has each term).

    Rounds are parts by a hash of the item; their number doubles until none passes ROUND_BYTES. Only
    a single item can be larger than that.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = saved(
        items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).withColumn(
            "deal", F.xxhash64("item_id", "text", F.monotonically_increasing_id())
        )
    )
    count, parts = rows.count(), 1
    while True:
        part = F.pmod("deal", F.lit(parts)).alias("part")
        sizes = {r.part: r.bytes for r in rows.groupBy(part).agg(F.sum(F.octet_length("text") + 64).alias("bytes")).collect()}
        if max(sizes.values(), default=0) <= ROUND_BYTES or parts >= 2 * count:
            break
        parts *= 2
    for k in sorted(sizes):
        chosen = rows.where(F.pmod("deal", F.lit(parts)) == k).select("item_id", "text")
        yield [(r.item_id, Counter(terms(r.text.encode()))) for r in chosen.collect()]


def _postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Per document its number of terms and those of the vocabulary with their counts: doc_id, n, term, tf."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))]
    )
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: k for k, t in enumerate(shared.value)}.get
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                counts, ends, found, often = [], [0], [], []
                for text in part.column(1).cast(pa.large_binary()).to_pylist():
                    held = terms(text) if text else []
                    counts.append(len(held))
                    tf = Counter(map(place, held))
                    tf.pop(None, None)
                    found += tf.keys()
                    often += tf.values()
                    ends.append(len(found))
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (found, often)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), *lists], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, term array<int>, tf array<int>")


def _weights(posted: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """Weight of every term of the vocabulary, from the documents that hold it."""
    df = dict(posted.select(F.explode("term").alias("term")).groupBy("term").count().collect())
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(k, 0) + 1))) for k in range(size)], np.int64)


def _tiles(asked: list[Counter], place: dict[bytes, int], weight: np.ndarray) -> list[tuple]:
    """(first item, its vocabulary, where the vocabulary is cut, matrix items x terms) of every tile."""
    out = []
    for first in range(0, len(asked), TILE_ITEMS):
        part = asked[first : first + TILE_ITEMS]
        vocabulary = np.array(sorted({place[t] for c in part for t in c}), np.int64)
        matrix = np.zeros((len(part), len(vocabulary)))
        at = {int(v): k for k, v in enumerate(vocabulary)}
        for row, counts in enumerate(part):
            for t, times in counts.items():
                matrix[row, at[place[t]]] = times * int(weight[place[t]])
        cuts = [0]
        reach = np.zeros(len(part))
        for k in range(len(vocabulary)):
            reach += matrix[:, k] * MOST_IMPACT
            if k > cuts[-1] and reach.max() >= EXACT:
                cuts.append(k)
                reach = matrix[:, k] * MOST_IMPACT
        out.append((first, vocabulary, [*cuts, len(vocabulary)], matrix))
    return out


def _impacts(posted: pa.RecordBatch, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and impact of every posting of a batch."""
    length = posted.column(1).to_pylist()
    most = [100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // n_terms for n in length]
    lists = posted.column(2)
    counts = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(counts)), counts)
    tf = posted.column(3).flatten().to_numpy().astype(np.int64)
    m = np.array(most, np.int64)[row] if len(row) else np.zeros(0, np.int64)
    return row, lists.flatten().to_numpy().astype(np.int64), (SCALE * tf) // (1000 * tf + SATURATION * m)


class _Best:
    """The ``top`` best (score, smallest id) of every item so far; a document without id comes after all others."""

    LAST = np.iinfo(np.int64).max

    def __init__(self, items: int, top: int):
        self.top = top
        self.score = [np.zeros(0, np.int64)] * items
        self.id = [np.zeros(0, np.int64)] * items
        self.bar = np.ones(items, np.int64)  # a score has to reach this

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.bar[first : first + len(scores), None]
        for row in np.flatnonzero(good.any(1)).tolist():
            at = np.flatnonzero(good[row])
            score = np.concatenate([self.score[first + row], scores[row, at]])
            who = np.concatenate([self.id[first + row], ids[at]])
            order = np.lexsort((who, -score))[: self.top]
            self.score[first + row], self.id[first + row] = score[order], who[order]
            if len(order) == self.top:
                self.bar[first + row] = score[order[-1]]


def _scored(posted: DataFrame, tiles: list[tuple], items: int, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """The best documents of every item in each task: item (its place in the round), salt, doc_id, score."""
    schema = pa.schema([("item", pa.int32()), ("salt", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
    shared = posted.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(items, top)
        for batch in batches:
            ids = batch.column(0).fill_null(_Best.LAST).to_numpy()
            for first in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(first, BLOCK_DOCS)
                row, term, impact = _impacts(part, n_docs, n_terms)
                for tile in shared.value:
                    for begin, scores in _products(tile, row, term, impact, part.num_rows):
                        best.add(tile[0], scores, ids[first + begin : first + begin + scores.shape[1]])
        item = np.repeat(np.arange(items, dtype=np.int32), [len(s) for s in best.score])
        if len(item):
            who = np.concatenate(best.id)
            salt = np.full(len(item), TaskContext.get().partitionId() % SALTS, np.int32)
            ids = pa.array(who, mask=who == _Best.LAST)
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(salt), ids, pa.array(np.concatenate(best.score))], schema=schema)

    return posted.mapInArrow(run, "item int, salt int, doc_id bigint, score bigint")


def _products(tile, row, term, impact, n_docs: int) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of a tile's items in a block of documents: (first document, items x documents)."""
    _, vocabulary, cuts, matrix = tile
    if not len(vocabulary):
        return
    at = np.searchsorted(vocabulary, term)
    mine = vocabulary[np.minimum(at, len(vocabulary) - 1)] == term
    row, at, impact = row[mine], at[mine], impact[mine]
    step = max(1, BLOCK_CELLS // len(vocabulary))
    for begin in range(0, n_docs, step):
        width = min(step, n_docs - begin)
        lo, hi = np.searchsorted(row, [begin, begin + width])
        block = np.zeros((width, len(vocabulary)))
        block[row[lo:hi] - begin, at[lo:hi]] = impact[lo:hi]
        scores = np.zeros((len(matrix), width), np.int64)
        for a, b in zip(cuts, cuts[1:]):
            scores += (matrix[:, a:b] @ block[:, a:b].T).astype(np.int64)
        yield begin, scores


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` highest-scoring documents of every item: item_id, rank (from 1), doc_id, score.

    A term's impact in a document is ``10^9 tf div (1000 tf + 8 m)`` with ``m`` growing with the
    document's length against the mean; a score adds weight times impact over the item's terms,
    repeats included. Only scores above 0 are ranked. Equal scores are ordered by doc_id, documents
    without one last. Every item row is ranked by itself, also when ids repeat or are null; repeated
    documents count and rank as documents of their own. Null and empty texts have no terms and take
    no part in the corpus counts. Very long texts are read whole. Other columns are ignored; without
    documents or items the result is empty.
    """
    out = None
    for batch in _item_rounds(items):
        asked = [c for _, c in batch]
        vocabulary = sorted({t for c in asked for t in c})
        posted = written(_postings(docs, vocabulary))
        stats = posted.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not stats.docs or not vocabulary:
            continue
        weight = _weights(posted, stats.docs, len(vocabulary))
        tiles = _tiles(asked, {t: k for k, t in enumerate(vocabulary)}, weight)
        held = posted.where(F.size("term") > 0)
        found = _scored(held, tiles, len(batch), stats.docs, stats.terms, top)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for by in (["item", "salt"], ["item"]):
            rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
            found = found.withColumn("rank", rank).where(F.col("rank") <= top)
        names = docs.sparkSession.createDataFrame([(k, i) for k, (i, _) in enumerate(batch)], "item int, item_id bigint")
        round_ = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = round_ if out is None else out.unionByName(round_)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out


def oracle_sql(top: int = TOP) -> str:
    """The same ranking by joining terms, without matrices."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({fold}, '{pattern}') AS t FROM benchmark),
q AS (SELECT item, unnest(t) AS term FROM i),
asked AS (SELECT item, term, count(*) AS times FROM q GROUP BY ALL),
d AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({fold}, '{pattern}') AS t FROM documents),
sizes AS (SELECT doc, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
h AS (SELECT doc, unnest(t) AS term FROM d),
tf AS (SELECT doc, term, count(*)::BIGINT AS tf FROM h WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term),
p AS (SELECT doc, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)) AS impact FROM tf JOIN sizes USING (doc), c),
s AS (SELECT item, doc, any_value(doc_id) AS doc_id, sum(times * w * impact)::BIGINT AS score
  FROM p JOIN w USING (term) JOIN asked USING (term) GROUP BY item, doc),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r JOIN i USING (item) WHERE rank <= {top}"""
