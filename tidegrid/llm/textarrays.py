"""Word and shingle hashes of Arrow text columns, computed on whole byte arrays.

Texts are taken in slices of about a megabyte, so memory does not depend on the batch. A word is
a maximal run of bytes other than space and the five ASCII controls from tab on; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WIDTH = 5  # words in a shingle

_rng = np.random.default_rng(20240501)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)[_FOLD]  # a random value for each folded byte
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _rng.integers(1, 2**63, WIDTH, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: np.uint64, n: int, cache: dict = {}) -> np.ndarray:  # noqa: B006
    have = cache.get(int(base))
    if have is None or len(have) < n:
        out = np.full(max(n, SLICE_BYTES * 2), base, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= SLICE_BYTES * 2:
            cache[int(base)] = have
    return have[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off


def slices(off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES; a longer text is a range of its own."""
    first = 0
    while first < len(off) - 1:
        last = int(np.searchsorted(off, off[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(off) - 1)
        yield first, last
        first = last


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, number of words per row, and where words start and end in ``raw``."""
    lo, hi = int(off[0]), int(off[-1])
    data, rows = raw[lo:hi], off - lo
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), np.zeros(len(off) - 1, np.int64), none, none
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[rows] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, n), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _powers(_BASE_INV, n)[starts])
    counts = np.diff(np.searchsorted(starts, rows))
    return hashes, counts, starts + lo, ends + lo


def shingle_hashes(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles, in order, and their number per row.

    A row with one to four words has one shingle, its whole word sequence; one without words, none.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    out_counts = np.where(counts >= WIDTH, counts - WIDTH + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), out_counts)
    first = begins[row] + np.arange(len(row)) - np.repeat(np.cumsum(out_counts) - out_counts, out_counts)
    left = np.minimum(ends[row] - first, WIDTH)
    total = left.astype(np.uint64)
    full = left == WIDTH
    for k in range(WIDTH):
        # a word beyond the row's last adds nothing
        there = words[np.minimum(first + k, len(words) - 1)] if len(words) else words
        total += np.where(full | (left > k), there * _PLACE[k], np.uint64(0))
    return mixed(total), out_counts
