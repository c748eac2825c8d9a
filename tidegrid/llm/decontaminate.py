"""Benchmark passages in documents, by SimHash over item-sized windows.

Items of similar length form a size class with one window length, a little under the shortest
item. An item is known by the 64-bit SimHash fingerprints of a few of its windows; a document is
walked window by window. A fingerprint is cut into four blocks of 16 bits, and every item
fingerprint is filed under all block values within two bits of its own. Fingerprints within eleven
bits of each other agree to two bits in some block, so every pair within that radius meets.
What meets and is within the radius is compared exactly: the shingles of as many document words
as the item has against those of the item, every occurrence with its weight, at the aligned place
and a few words around it. From 0.75 on it is a match.

At 0.75 itself two fingerprints of whole items are eleven bits apart on average, so that radius
alone loses passages near the threshold. Windows over a part of the item do not. Every place where a
passage departs from the item costs at least four of the item's shingles and brings as many others in,
so at 0.75 an item of N shingles is cut at no more than N / 28 places, and its longest unchanged
stretch has at least PART_RUN shingles (three quarters of N for an item too short to be cut). Each
item is therefore also known by the fingerprints of part windows at every offset, and the walk's steps
are so short that such a stretch holds one of its windows. They are filed under the exact values of
two blocks of 32 bits, which guarantees a radius of one bit. A document and an item that meet in a part window are compared at every
place of the document, up to a few words over its ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import where_text
from tidegrid.llm.textarrays import WIDTH, shingle_hashes, slices, text_buffers, word_hashes

THRESHOLD = 0.75
BITS, BLOCKS, BLOCK_RADIUS = 64, 4, 2
BLOCK_BITS = BITS // BLOCKS
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Longest over shortest item of a size class.
RATIO = 1.25
#: Words that a window is shorter than the shortest item of its class, and the step of windows.
SLACK, STEP = 3, 2
#: Words around the aligned place that the exact comparison tries.
AROUND = 3
#: Items, and bytes of their texts, that one pass over the documents looks for; more take more passes.
ITEMS_PER_PASS, BYTES_PER_PASS = 2000, 8 << 20
#: Shingles of the shortest stretch that a match leaves unchanged in an item of PART_FROM shingles and more.
PART_RUN, PART_FROM = 12, 28
#: Low bits of half a fingerprint that tell at once that no part window is filed under it.
MASK_BITS = 20
_MASK, _HALF = np.uint64((1 << MASK_BITS) - 1), np.uint64((1 << 32) - 1)


def _near_values() -> np.ndarray:
    """All 16-bit patterns with at most BLOCK_RADIUS bits."""
    values = np.arange(1 << BLOCK_BITS, dtype=np.uint64)
    return values[np.bitwise_count(values) <= BLOCK_RADIUS]


def part_shingles(n: int) -> tuple[int, int]:
    """Shingles of the part windows of an item of ``n`` shingles, and the step of the walk.

    An item has a part window at every offset. The shortest stretch that a match leaves unchanged is
    as long as a window and a step less one, so some window of the walk lies in it.
    """
    run = PART_RUN if n >= PART_FROM else max(2, int(np.ceil(THRESHOLD * n)))
    step = max(1, run // 2)
    return run - step + 1, step


def _bit_sums(hashes: np.ndarray, kind: type) -> np.ndarray:
    """Running count of each of the 64 bits, as counters of ``kind`` packed into longs.

    The sums may run over; the difference of two rows is right as long as the counts of what lies
    between them fit their counters.
    """
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(kind, copy=False).view(np.uint64)
    out = np.zeros((len(hashes) + 1, bits.shape[1]), np.uint64)
    np.cumsum(bits, axis=0, out=out[1:])
    return out


def _fingerprints(sums: np.ndarray, kind: type, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the shingles begin..end: bits that more than half of them have."""
    ones = (sums[end] - sums[begin]).view(kind)
    half = ((end - begin) // 2).astype(kind)
    return np.packbits(ones > half[:, None], axis=1).view(np.uint64).ravel()


def _count_kind(window: int) -> type:
    return np.uint8 if window < 256 else np.uint16 if window < 65536 else np.uint32


@dataclass
class SizeClass:
    """Items of lengths lowest..highest; ``window`` words at a time, every ``step`` words.

    Fingerprints within RADIUS bits meet. Part windows meet within one bit, by the halves of their
    fingerprints; ``may_meet`` tells by a half's low bits that nothing is filed there.
    """

    window: int
    step: int
    lowest: int
    highest: int
    part: bool = False
    prints: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    starts: list[np.ndarray] = field(default_factory=list)  # of each block value's fingerprints
    members: list[np.ndarray] = field(default_factory=list)
    may_meet: list[np.ndarray] = field(default_factory=list)

    def file_parts(self) -> None:
        for h in range(2):
            half = self.prints >> np.uint64(32 * h) & _HALF
            order = np.argsort(half, kind="stable")
            self.members.append(order)
            self.starts.append(half[order])
            seen = np.zeros(1 << MASK_BITS, bool)
            seen[half & _MASK] = True
            self.may_meet.append(seen)

    def parts_meeting(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item fingerprint) within one bit."""
        found = []
        for h in range(2):
            half = prints >> np.uint64(32 * h) & _HALF
            some = np.flatnonzero(self.may_meet[h][half & _MASK])
            first = np.searchsorted(self.starts[h], half[some], "left")
            n = np.searchsorted(self.starts[h], half[some], "right") - first
            window = np.repeat(some, n)
            place = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
            entry = self.members[h][place]
            close = np.bitwise_count(prints[window] ^ self.prints[entry]) <= 1
            found.append(window[close] * len(self.prints) + entry[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // max(len(self.prints), 1), pairs % max(len(self.prints), 1)

    def meeting(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item fingerprint) within the radius."""
        found = []
        for b in range(BLOCKS):
            value = ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            first = self.starts[b][value]
            n = self.starts[b][value + 1] - first
            some = np.flatnonzero(n)
            n = n[some]
            window = np.repeat(some, n)
            place = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[some], n)
            entry = self.members[b][place]
            close = np.bitwise_count(prints[window] ^ self.prints[entry]) <= RADIUS
            found.append(window[close] * len(self.prints) + entry[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // max(len(self.prints), 1), pairs % max(len(self.prints), 1)


class Items:
    """The items of one pass: their shingles with weights, and their size classes."""

    def __init__(self, ids: list[int], texts: list[str]):
        raw, off = text_buffers(pa.array(texts, pa.string()))
        self.ids, self.words, self.shingles, self.parts, self.classes = [], [], [], [], []
        for k, item in enumerate(ids):
            hashes, counts, _, _ = word_hashes(raw, off[k : k + 2])
            if len(hashes):
                self.ids.append(item)
                self.words.append(hashes)
                self.shingles.append(np.unique(shingle_hashes(hashes, counts)[0], return_counts=True))
        for lowest, highest, (part, step) in self._parts():
            self.parts.append(self._filed(SizeClass(part + WIDTH - 1, step, lowest, highest, True)))
        lengths = sorted({len(w) for w in self.words})
        while lengths:
            low = lengths[0]
            roomy = low >= WIDTH + SLACK
            high = max(n for n in lengths if n == low or (roomy and n <= low * RATIO))
            lengths = [n for n in lengths if n > high]
            self.classes.append(self._filed(SizeClass(low - SLACK if roomy else low, STEP if roomy else 1, low, high)))

    def _parts(self) -> list[tuple[int, int, tuple[int, int]]]:
        """Shortest and longest item of each kind of part window; items without room for one are searched whole."""
        lengths = sorted({len(w) for w in self.words if len(w) >= WIDTH + SLACK})
        kinds: dict[tuple[int, int], list[int]] = {}
        for n in lengths:
            kinds.setdefault(part_shingles(n - WIDTH + 1), []).append(n)
        return [(min(n), max(n), kind) for kind, n in kinds.items()]

    def _filed(self, size: SizeClass) -> SizeClass:
        prints, item, offset = [], [], []
        for k, words in enumerate(self.words):
            if size.lowest <= len(words) <= size.highest:
                room = len(words) - size.window
                # pairs of neighbours at both ends and in the middle: one of each pair is on the walk
                at = range(room + 1) if size.part else sorted({o for p in (0, room // 2, room - 1) for o in (p, p + 1) if 0 <= o <= room})
                hashes, _ = shingle_hashes(words, np.array([len(words)]))
                begin = np.array(at)
                end = begin + max(size.window - WIDTH + 1, 1)
                kind = _count_kind(size.window)
                prints.append(_fingerprints(_bit_sums(hashes, kind), kind, begin, end))
                item += [k] * len(at)
                offset += at
        size.prints, size.item, size.offset = np.concatenate(prints), np.array(item), np.array(offset)
        if size.part:
            size.file_parts()
            return size
        near = _near_values()
        for b in range(BLOCKS):
            own = (size.prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)
            values = (own[:, None] ^ near[None, :]).astype(np.int64)
            order = np.argsort(values, axis=None, kind="stable")
            size.members.append((order // len(near)).astype(np.int64))
            size.starts.append(np.searchsorted(values.ravel()[order], np.arange((1 << BLOCK_BITS) + 1)))
        return size

    def _best_place(self, k: int, words: np.ndarray, hashes: np.ndarray) -> tuple[float, int, int]:
        """(similarity, first, end) of the window of a text that is most similar to an item, the first of equal ones.

        Windows are compared in the order of the similarity that their number of item shingles allows.
        """
        kinds, weight = self.shingles[k]
        total, length = int(weight.sum()), len(self.words[k])
        place = np.minimum(np.searchsorted(kinds, hashes), len(kinds) - 1)
        seen = np.concatenate([[0], np.cumsum(kinds[place] == hashes)])
        start = np.arange(-AROUND, max(len(words) - length, 0) + AROUND + 1)
        a, b = np.maximum(start, 0), np.minimum(start + length, len(words))
        begin = np.minimum(a, len(hashes))
        end = np.maximum(b - WIDTH + 1, begin)
        common = np.minimum(seen[end] - seen[begin], total)
        most = common / (total + (end - begin) - common)
        some = np.flatnonzero(most >= THRESHOLD)
        top = (0.0, 0, 0)
        for p in some[np.argsort(-most[some], kind="stable")].tolist():
            if most[p] < top[0]:
                break
            s = self.similarity(k, hashes[begin[p] : end[p]])
            if s > top[0] or (s == top[0] and a[p] < top[1]):
                top = (s, int(a[p]), int(b[p]))
        return top

    def similarity(self, k: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item's and a window's shingles; every occurrence weighs one."""
        kinds, weight = self.shingles[k]
        own, own_weight = np.unique(window, return_counts=True)
        _, i, j = np.intersect1d(kinds, own, assume_unique=True, return_indices=True)
        common = int(np.minimum(weight[i], own_weight[j]).sum())
        return common / (int(weight.sum()) + len(window) - common)

    def matches(self, raw: np.ndarray, off: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(row, item, similarity, first byte, end byte) of the best place of each item in each text of a slice."""
        words, counts, begins, ends = word_hashes(raw, off)
        last = np.cumsum(counts)
        first = last - counts
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        walked: dict = {}
        sums: dict = {}
        searched: set[tuple[int, int]] = set()
        for size in (*self.parts, *self.classes):
            width, kind = min(WIDTH, size.window), _count_kind(size.window)
            if width not in walked:
                walked[width] = self._walked(words, counts, first, width)
            hashes, n, at = walked[width]
            if (width, kind) not in sums:
                sums[width, kind] = _bit_sums(hashes, kind)
            # windows start every ``step`` words; a text shorter than a window is one window
            shingles = max(size.window - WIDTH + 1, 1)
            per = np.where(n >= shingles, (n - shingles) // size.step + 1, np.minimum(n, 1))
            row = np.repeat(np.arange(len(n)), per)
            step = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
            begin = at[row] + step * size.step
            end = np.minimum(begin + shingles, (at + n)[row])
            prints = _fingerprints(sums[width, kind], kind, begin, end)
            window, entry = size.parts_meeting(prints) if size.part else size.meeting(prints)
            if size.part:
                pairs = np.unique(row[window] * np.int64(len(self.words)) + size.item[entry])
                for r, k in zip((pairs // len(self.words)).tolist(), (pairs % len(self.words)).tolist()):
                    searched.add((r, k))
                    if counts[r] >= WIDTH:  # a shorter text is one shingle, which no longer item has
                        s, a, b = self._best_place(k, words[first[r] : first[r] + counts[r]], hashes[at[r] : at[r] + n[r]])
                        if s >= THRESHOLD:
                            best[r, k] = (s, int(begins[first[r] + a]), int(ends[first[r] + b - 1]))
                continue
            for w, e in zip(window.tolist(), entry.tolist()):
                r, k = int(row[w]), int(size.item[e])
                if (r, k) in searched:
                    continue
                start = int(step[w]) * size.step - int(size.offset[e])
                length = len(self.words[k])
                top = best.get((r, k), (0.0, 0, 0))
                for p in range(start - AROUND, start + AROUND + 1):
                    a, b = max(p, 0), min(p + length, int(counts[r]))
                    if a >= b or top[0] == 1.0:
                        continue
                    own, _ = shingle_hashes(words[first[r] + a : first[r] + b], np.array([b - a]))
                    s = self.similarity(k, own)
                    if s > top[0]:
                        top = (s, int(begins[first[r] + a]), int(ends[first[r] + b - 1]))
                if top[0] >= THRESHOLD:
                    best[r, k] = top
        return [(r, self.ids[k], s, a - int(off[r]), b - int(off[r])) for (r, k), (s, a, b) in sorted(best.items())]

    @staticmethod
    def _walked(words: np.ndarray, counts: np.ndarray, first: np.ndarray, width: int):
        """Shingle hashes of a class's width, their number per row and the rows' first ones."""
        if width == WIDTH:
            hashes, n = shingle_hashes(words, counts)
        else:  # items of fewer than five words: every run of as many words is one shingle
            n = np.maximum(counts - width + 1, 0)
            row = np.repeat(np.arange(len(n)), n)
            start = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            runs = (start[:, None] + np.arange(width)).ravel()
            hashes, _ = shingle_hashes(words[runs], np.full(len(start), width))
        return hashes, n, np.cumsum(n) - n


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[tuple[int, ...], tuple[str, ...]]]:
    """Ids and texts of the items in blocks of about ITEMS_PER_PASS items or BYTES_PER_PASS bytes.

    Null and empty items match nothing. Of rows that repeat an item_id the texts all count.
    """
    rows = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null and item_id is not null")
    rows = rows.distinct()
    held = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-held["n"] // ITEMS_PER_PASS), -(-held["bytes"] // BYTES_PER_PASS))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if part:
            yield tuple(r[0] for r in part), tuple(r[1] for r in part)


_filed: dict[int, Items] = {}


def _items_of(block: tuple[tuple[int, ...], tuple[str, ...]]) -> Items:
    """The filed items of a block: a worker files a block once, and keeps one."""
    key = hash(block)
    if key not in _filed:
        _filed.clear()
        _filed[key] = Items(*block)
    return _filed[key]


def _found(items: Items, column: pa.Array) -> Iterator[tuple[int, tuple[int, int, float, int, int]]]:
    raw, off = text_buffers(column)
    for a, b in slices(off):
        for row, *rest in items.matches(raw, off[a : b + 1]):
            yield a + row, tuple(rest)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items in documents: doc_id, item_id, similarity, start_byte, end_byte.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``; other columns
    are ignored. One row per row of ``docs`` and item, with the best place (the first of equal
    ones); clean documents have none. Words are lower-cased by A-Z and parted by ASCII white space,
    so case, line breaks and spacing do not matter. Null, empty and wordless texts match nothing.
    An item of fewer than five words matches its very word sequence. Repeated rows each come out; a
    null doc_id is kept. Very long texts are searched whole. With an empty table on either side the result is empty.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()),
         ("start_byte", pa.int64()), ("end_byte", pa.int64())]
    )
    ddl = "doc_id bigint, item_id bigint, similarity double, start_byte bigint, end_byte bigint"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    out = spark.createDataFrame([], ddl)
    for block in item_blocks(benchmark):
        out = out.union(rows.mapInArrow(_rows_of(spark.sparkContext.broadcast(block), schema), ddl))
    return out


def _rows_of(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items_of(shared.value)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = [(ids[r], *rest) for r, rest in _found(items, batch.column("text"))]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, f)) for f in found], schema=schema)

    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns; nothing is shuffled."""
    for block in item_blocks(benchmark):
        docs = where_text(docs, _without(docs.sparkSession.sparkContext.broadcast(block)))
    return docs


def _without(shared):
    def test(text: pa.Array) -> np.ndarray:
        out = np.ones(len(text), bool)
        out[[row for row, _ in _found(_items_of(shared.value), text)]] = False
        return out

    return test
