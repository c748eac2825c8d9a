"""Periodic runs of words, found by block convolution.

A run is a stretch of words in which words ``q`` apart are equal, ``q`` being its smallest period,
and which no neighbouring word extends. Wanted are runs of at least TIMES periods.

Distances are searched at dyadic scales. At scale ``D`` the text has a block at every multiple of
``D``, and the scale looks for the block's copies at distances from ``D`` to ``2 D - 1``. A run with
a period ``q`` in that range holds a whole block together with its copy ``q`` further on, because
three periods are longer than two blocks. A copy is where the sum of squared differences between the
block and the window is zero. These sums are ``sum a^2 + sum b^2 - 2 sum ab``; the last is a
correlation, computed for all distances at once by number-theoretic transforms. Words are small
integers and sums are taken modulo enough primes to exceed the largest possible sum, so zero means
equal words, not nearly equal ones. Each (block, distance) is a seed that is extended word by word.

The transforms are products with small matrices in float64: entries lie below 2^23 and at most 64
products are added, which stays below 2^53, so every sum is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import words

#: A run has at least TIMES periods and LEAST words.
TIMES, LEAST = 4, 6
#: Words of the longest block; a longer scale takes the first BLOCK words at each of its multiples.
BLOCK = 2048
#: Side of the largest transform matrix.
SIDE = 64
#: Bytes of text that are worked on together; a longer text is worked on alone.
SLICE_BYTES = 1 << 20
#: Elements of a transform worked on together.
CELLS = 1 << 18

RUN = "struct<start:bigint,length:bigint,period:bigint>"


@lru_cache
def _primes(count: int) -> tuple[int, ...]:
    """The largest primes below 2^23 that have a root of unity of order ``2 * BLOCK``."""
    out, p = [], 2**23 // (2 * BLOCK) * 2 * BLOCK + 1
    while len(out) < count:
        p -= 2 * BLOCK
        if all(p % k for k in range(3, int(p**0.5) + 1, 2)):
            out.append(p)
    return tuple(out)


def _reduced(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p`` in place, between -1 and ``p``: the quotient may be one off at its edges."""
    x -= np.floor(x * (1.0 / p)) * p
    return x


class Transform:
    """Transforms modulo ``p`` of rows of ``2 * block`` values whose second half is zero or unwanted.

    The order of the coefficients is that of two matrix steps; ``minus`` maps each to that of the
    negative frequency, and ``sign`` is what a shift by ``block`` multiplies it with.
    """

    def __init__(self, block: int, p: int):
        size = 2 * block
        root = next(r for g in range(2, p) if pow(r := pow(g, (p - 1) // size, p), block, p) == p - 1)
        power = np.ones(size, np.int64)
        for k in range(1, size):
            power[k] = power[k - 1] * root % p
        first = min(size, 1 << (size.bit_length() // 2)) if size > SIDE else size
        second = size // first
        a, b = np.arange(first), np.arange(second)
        self.p, self.block, self.first, self.second = p, block, first, second
        self.rows = power[np.outer(a, a) * second % size].astype(float)
        self.rows_back = power[-np.outer(a, a) * second % size].astype(float)
        self.cols = power[np.outer(b, b) * first % size].astype(float)
        self.cols_back = power[-np.outer(b, b) * first % size].astype(float)
        self.twist = power[np.outer(a, b) % size].astype(float)
        self.twist_back = power[-np.outer(a, b) % size].astype(float)
        frequency = (a[:, None] + first * b[None, :]).ravel()
        place = np.argsort(frequency)
        self.minus = place[-frequency % size]
        self.sign = np.where(frequency % 2, -1.0, 1.0)
        self.share = pow(size, -1, p)

    def forward(self, x: np.ndarray) -> np.ndarray:
        p, half = self.p, self.first // 2
        if self.second == 1:
            return _reduced(x @ self.rows[:half], p)
        y = _reduced(np.matmul(self.rows[:, :half], x.reshape(len(x), half, self.second)), p)
        y = _reduced(y * self.twist, p)
        return _reduced(y @ self.cols, p).reshape(len(x), -1)

    def back(self, y: np.ndarray) -> np.ndarray:
        p, half = self.p, self.first // 2
        if self.second == 1:
            x = _reduced(y @ self.rows_back[:, :half], p)
        else:
            y = _reduced(y.reshape(len(y), self.first, self.second) @ self.cols_back, p)
            y = _reduced(y * self.twist_back, p)
            x = _reduced(np.matmul(self.rows_back[:half], y), p).reshape(len(y), -1)
        return _reduced(x * self.share, p)


@lru_cache(maxsize=64)
def _transform(block: int, p: int) -> Transform:
    return Transform(block, p)


def _equal_blocks(ids: np.ndarray, at: np.ndarray, ahead: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, offset) where the block at ``at[row]`` equals the one at ``ahead[row] + offset``.

    Both are multiples of ``block``, and offsets go from 0 to ``block - 1``. ``ids`` has two blocks of
    room at its end.
    """
    most = block * int(ids.max()) ** 2
    count, reach = 1, _primes(1)[0]
    while reach <= most:
        count += 1
        reach *= _primes(count)[-1]
    rows = np.arange(len(at))
    for p in _primes(count):
        t = _transform(block, p)
        residues = ids % p
        squares = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(residues * residues % p, out=squares[1:])
        found = []
        step = max(1, CELLS // (2 * block))
        for first in range(0, len(rows), step):
            part = rows[first : first + step]
            a, b = at[part] // block, ahead[part] // block
            needed, where = np.unique(np.concatenate([a, b, b + 1]), return_inverse=True)
            cells = needed[:, None] * block + np.arange(block)
            spectrum = t.forward(residues[cells].astype(float))
            mine, near, far = where[: len(a)], where[len(a) : 2 * len(a)], where[2 * len(a) :]
            window = spectrum[near] + t.sign * spectrum[far]
            cross = t.back(_reduced(spectrum[mine][:, t.minus] * window, p))
            begin = ahead[part][:, None] + np.arange(block)
            own = squares[at[part] + block] - squares[at[part]]
            total = _reduced((squares[begin + block] - squares[begin] + own[:, None]).astype(float) - 2 * cross, p)
            row, offset = np.nonzero((total == 0) | (total == p))
            found.append((part[row], offset))
        hits = [np.concatenate(c) for c in zip(*found)] if found else [rows, rows]
        keep = hits if p == _primes(count)[0] else _both(keep, hits, block)
        rows = np.unique(keep[0])
    return keep[0], keep[1]


def _both(a, b, block: int):
    keys = np.intersect1d(a[0] * block + a[1], b[0] * block + b[1])
    return [keys // block, keys % block]


def _extended(ids: np.ndarray, at: np.ndarray, by: np.ndarray, limit: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``at`` on in direction ``way`` equal the words ``by`` further on, before ``limit``."""
    out = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    width = 16
    while len(open_):
        parts = []
        for first in range(0, len(open_), max(1, CELLS // width)):
            part = open_[first : first + max(1, CELLS // width)]
            here = (at[part] + way * out[part])[:, None] + way * np.arange(width)
            inside = here < limit[part][:, None] if way > 0 else here >= limit[part][:, None]
            here = np.where(inside, here, at[part][:, None])
            same = inside & (ids[here] == ids[here + np.where(inside, by[part][:, None], 0)])
            run = np.where(same.all(1), width, same.argmin(1))
            out[part] += run
            parts.append(part[run == width])
        open_ = np.concatenate(parts)
        width = min(2 * width, 4096)
    return out


def runs_of(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs of the documents laid end to end in ``ids``.

    ``ends`` is where each document ends. Order: by start, then period.
    """
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    length = ends - begins
    document = np.repeat(np.arange(len(ends)), length)
    n = len(ids)
    runs: dict[tuple[int, int], int] = {}
    scale = 1
    while n and TIMES * scale <= length.max():
        block = min(scale, BLOCK)
        room = np.zeros(-(-n // block) * block + 3 * block, np.int64)
        room[:n] = ids
        at = np.arange(0, n, scale)
        stop = ends[document[at]]
        able = (length[document[at]] >= max(LEAST, TIMES * scale)) & (at + scale + block <= stop)
        at, stop = at[able], stop[able]
        pieces = scale // block
        seeds = np.repeat(at, pieces)
        ahead = seeds + scale + np.tile(np.arange(pieces), len(at)) * block
        stops = np.repeat(stop, pieces)
        there = ahead + block <= stops
        seeds, ahead, stops = seeds[there], ahead[there], stops[there]
        if len(seeds):
            row, offset = _equal_blocks(room, seeds, ahead, block)
            by = ahead[row] + offset - seeds[row]
            seed, stop = seeds[row], stops[row]
            ok = seed + by + block <= stop
            seed, by = seed[ok], by[ok]
            ok = _open_seeds(ids, seed, by, block, begins[document[seed]], ends[document[seed]], runs)
            seed, by = seed[ok], by[ok]
            for s, e, q in _grown(ids, seed, by, scale, block, document, begins, ends):
                runs.setdefault((s, e), q)  # a multiple of the period gives the same stretch later
        scale *= 2
    found = np.array(sorted((s, q, e) for (s, e), q in runs.items()), np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 2], found[:, 1]


def _open_seeds(ids, seed, by, block, low, high, runs) -> np.ndarray:
    """Seeds that can lead to a run not known yet.

    A block inside a known run of at most a quarter of its length matches at every multiple of that
    period while the run lasts. If the copy lies in it too, the seed only finds that run again. If it
    does not, a longer period has to repeat the word that ends the run.
    """
    ok = np.ones(len(seed), bool)
    known = np.array(sorted((s, e) for (s, e), q in runs.items() if 4 * q <= block <= e - s), np.int64).reshape(-1, 2)
    if not len(known):
        return ok
    # such runs overlap by less than half a block, so only the last one that started can hold a block
    last = np.searchsorted(known[:, 0], seed, "right") - 1
    end = known[np.maximum(last, 0), 1]
    held = (last >= 0) & (seed + block <= end)
    again = held & (seed + by + block <= end)
    here = np.where(held & ~again, end, seed)
    after, before = here + by, here - by
    word = ids[here]
    repeats = ((after < high) & (ids[np.minimum(after, high - 1)] == word)) | (
        (before >= low) & (ids[np.maximum(before, low)] == word)
    )
    return ~held | (~again & repeats)


def _grown(ids, seed, by, scale, block, document, begins, ends) -> Iterator[tuple[int, int, int]]:
    """Stretches of period ``by`` around the seeds that are long enough: (start, end, period)."""
    order = np.lexsort((seed, by))
    seed, by = seed[order], by[order]
    while len(seed):
        # blocks in a row with one distance mostly lie in one stretch: look at the first of them
        new = np.ones(len(seed), bool)
        new[1:] = (by[1:] != by[:-1]) | (seed[1:] != seed[:-1] + scale) | (document[seed[1:]] != document[seed[:-1]])
        first, chain = np.flatnonzero(new), np.cumsum(new) - 1
        a, q = seed[first], by[first]
        b = a + block
        if scale == block:  # they meet, so all of them lie in it
            b = seed[np.append(first[1:], len(seed)) - 1] + block
        low, high = begins[document[a]], ends[document[a]]
        a = a - _extended(ids, a - 1, q, low, -1)
        b = b + _extended(ids, b, q, high - q, 1)
        long = b - a + q >= np.maximum(LEAST, TIMES * q)
        yield from zip(a[long].tolist(), (b + q)[long].tolist(), q[long].tolist())
        rest = seed + block > b[chain]
        seed, by = seed[rest], by[rest]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > first and size + n > SLICE_BYTES:
            yield first, k
            first, size = k, 0
        size += n
    if len(sizes):
        yield first, len(sizes)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of every document: doc_id, n_words, runs (start, length, period; by start, then period), kept.

    Words are separated by space and the ASCII controls from tab to carriage return, and differ when
    any byte does. ``kept`` is the text without repetitions: every word that some run holds after
    that run's first period is left out, and the rest is joined by single spaces.

    Texts of any length are searched whole, at every period; documents of a slice share numpy calls,
    a very long one is worked on alone, in memory proportional to its text. Null, empty and blank
    texts have no words and no runs. Repeated rows and missing ids stay as they are; other columns
    are ignored. An empty table gives an empty result.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", kind), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).fill_null("").cast(pa.large_binary())
            width = np.diff(np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1])
            for first, last in _slices(width):
                texts = sizes.slice(first, last - first).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *_worked(texts, kind)], schema=schema
                )

    def _worked(texts: list[bytes], kind) -> list[pa.Array]:
        tokens = [t.split() for t in texts]  # bytes are split at exactly the six separators
        counts = np.array([len(t) for t in tokens], np.int64)
        ids = np.empty(counts.sum(), np.int64)
        place = 0
        for t in tokens:
            seen: dict[bytes, int] = {}
            ids[place : place + len(t)] = [seen.setdefault(w, len(seen)) for w in t]
            place += len(t)
        ends = np.cumsum(counts)
        start, end, period = runs_of(ids, ends)
        gone = np.zeros(len(ids) + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.add.at(gone, end, -1)
        left = np.cumsum(gone)[:-1] == 0
        begins = ends - counts
        kept = []
        for t, a, b in zip(tokens, begins.tolist(), ends.tolist()):
            stay = left[a:b]
            kept.append(b" ".join(t if stay.all() else [t[k] for k in np.flatnonzero(stay)]))
        owner = np.searchsorted(ends, start, "right")
        rows = pa.StructArray.from_arrays(
            [pa.array(start - begins[owner]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]
        )
        limits = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
        return [
            pa.array(counts),
            pa.ListArray.from_arrays(pa.array(limits), rows).cast(kind),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, runs array<{RUN}>, kept string")


def with_planted_run(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document by the hash of its id repeats a stretch up to its end.

    Fixed values: with ``h`` the crc32 of the decimal id, ``g = h div 10`` and ``n`` words, documents
    with ``h mod 10 = 0`` have from word ``a = g mod n`` on the words from ``a`` repeated with period
    ``1 + (n - a) div (3 + g mod 8)``. Documents without words or id stay as they are.
    """
    text = F.col("text").cast("string")
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")).otherwise(text)

    # the words are bound once, as the variable of a one-element transform
    planted = F.element_at(F.transform(F.array(words(text)), repeated), 1)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(h % 10 == 0, planted).otherwise(text).alias("text")
    )


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and hashes of all runs and of the kept words."""
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    best = found.select("doc_id", "runs", "kept", longest.alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
