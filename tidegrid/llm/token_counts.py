"""Exact token counts of every prefix of a text under a byte-level BPE vocabulary.

Encoding splits a text into pieces (words with their leading space, runs of digits, of marks, of
white space) and each piece into tokens. Inside a piece the count follows from dynamic
programming: the encoding of a prefix ends in the one vocabulary entry that may stand after the
encoding of what precedes it, so its count is that shorter prefix's count plus one. Pieces repeat,
so their tables are kept; a text's table is the tables of its pieces laid end to end. Truncation
("how much fits in 512 tokens?") and budgets are then look-ups; nothing is encoded again.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
#: Code points whose tables leave Python in one batch.
BATCH_CHARS = 1 << 20
#: Pieces whose tables a worker keeps in each of two generations.
KEPT_PIECES = 600_000

# Fixed values of the vocabulary's splitting rule.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
)
RUNS = regex.compile(f"[{SPACE}]{{2,}}")
SPACE_ONE = regex.compile(f"[{SPACE}]")
LONG_SUFFIXES = ("'re", "'ve", "'ll")


def _byte_letters() -> dict[str, int]:
    """The vocabulary writes bytes as letters: visible ones as themselves, the rest from code 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    return letters


class Tables(dict):
    """Tables of pieces in two generations: when the young one is full, what it lacks is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_PIECES:
            self.old = dict(self)
            self.clear()
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
        self[piece] = found
        return found


class PrefixCounter:
    """Prefix tables under one vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = _byte_letters()
        as_bytes = lambda s: bytes(letter[c] for c in s)
        self.vocabulary = {as_bytes(t) for t in spec["model"]["vocab"] if all(c in letter for c in t)}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(as_bytes(a), as_bytes(b)): k for k, (a, b) in enumerate(merges)}
        self.made = {a + b: k for (a, b), k in self.rank.items()}
        self.split = {a + b: (a, b) for a, b in self.rank}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.longest = max(map(len, self.vocabulary))
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.widths: dict[bytes, bytes] = {}
        self.tables = Tables(self.table)

    def may_follow(self, a: bytes, b: bytes) -> bool:
        """Whether token b can stand right after token a in an encoding; at the start, a is empty.

        Merges happen in the order of their rank. Going back in time, the later made of the two
        tokens at the border is undone, down to single bytes; the border holds if no pair that
        ever met there would have merged before the next merge of either side.
        """
        known = self.follows.get((a, b))
        if known is not None:
            return known
        if len(self.follows) > 4 * KEPT_PIECES:
            self.follows.clear()
        never = len(self.rank)
        left, right, limit, known = a, b, never, True
        while left:
            if self.rank.get((left, right), never) < limit:
                known = False
                break
            made_left, made_right = self.made.get(left, -1), self.made.get(right, -1)
            if made_left < 0 and made_right < 0:
                break
            if made_left > made_right:
                left, limit = self.split[left][1], made_left
            else:  # of equal merges in a row the leftmost goes first: here it would be the border's
                right, limit = self.split[right][0], made_right + 1
        self.follows[a, b] = known
        return known

    def byte_counts(self, piece: bytes) -> list[int]:
        """Tokens of piece[:i] as one piece, for each i from 1 on.

        Only one token can end a prefix. Mostly it is the last one grown by a byte, or a short one,
        so those are tried first. A known piece that begins this one gives its part of the table.
        """
        n, widths = len(piece), self.widths
        for k in range(n, max(n - 12, 0), -1):
            known = widths.get(piece[:k])
            if known is not None:
                break
        else:
            known = b""
        counts, last = [0], list(known)
        for i, width in enumerate(known, 1):
            counts.append(counts[i - width] + 1)
        vocabulary, may_follow = self.vocabulary, self.may_follow
        for i in range(len(known) + 1, n + 1):
            for width in chain((last[-1] + 1 if last else 1,), range(1, min(i, self.longest) + 1)):
                token = piece[i - width : i]
                before = i - width
                if token in vocabulary and may_follow(piece[before - last[before - 1] : before] if before else b"", token):
                    counts.append(counts[before] + 1)
                    last.append(width)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        if len(widths) >= KEPT_PIECES:
            widths.clear()
        widths[piece] = bytes(last)
        return counts[1:]

    def table(self, piece: str) -> bytes:
        """Counts after each code point of a piece, as 32-bit integers."""
        raw = piece.encode()
        counts = self.byte_counts(raw)
        if len(raw) != len(piece):
            counts = [c for c, b in zip(counts, raw[1:] + b"a") if b & 0xC0 != 0x80]
        if piece in LONG_SUFFIXES:  # cut after its second letter it is two pieces
            counts[1] = 2
        return array("i", counts).tobytes()

    def _plain(self, text: str) -> np.ndarray:
        """Counts after each code point of a text without special tokens."""
        pieces = PIECE.findall(text)
        local = np.frombuffer(b"".join(map(self.tables.__getitem__, pieces)), np.int32)
        widths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        finals = local[np.cumsum(widths) - 1].astype(np.int64)
        counts = local + np.repeat(np.cumsum(finals) - finals, widths)
        # A prefix that ends with a run of spaces keeps the run in one piece; the text gives the
        # last space of a run to the word after it.
        for run in RUNS.finditer(text):
            a, b = run.span()
            if b < len(text):
                counts[b - 1] = (counts[a - 1] if a else 0) + np.frombuffer(self.tables[run.group()], np.int32)[-1]
        return counts

    def counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for i from 1 to the length of ``text``."""
        found = list(self.special.finditer(text)) if self.special else []
        if not found:
            return self._plain(text) if text else np.zeros(0, np.int64)
        parts, base, at = [], 0, 0
        for a, b in chain((m.span() for m in found), [(len(text), len(text))]):
            plain = self._plain(text[at:a]) if a > at else np.zeros(0, np.int64)
            parts.append(base + plain)
            whole = base + (int(plain[-1]) if len(plain) else 0)
            if b > a:  # inside a special token its letters are ordinary text
                pieces = PIECE.findall(text[at:a])
                start = a - (len(pieces[-1]) if pieces else 0)
                while start > at and SPACE_ONE.match(text, start - 1):
                    start -= 1
                before = base + (int(plain[start - at - 1]) if start > at else 0)
                inside = [before + int(self._plain(text[start:i])[-1]) for i in range(a + 1, b)]
                parts.append(np.array([*inside, whole + 1], np.int64))
            base, at = whole + 1, b
        return np.concatenate(parts)


_counters: dict[str, PrefixCounter] = {}


def counter(vocabulary: str = VOCABULARY) -> PrefixCounter:
    """The worker's counter for a vocabulary file of the installed package."""
    if vocabulary not in _counters:
        _counters[vocabulary] = PrefixCounter(public_tokenizers.path(vocabulary))
    return _counters[vocabulary]


def prefix_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token table of every text: doc_id, n_bytes, prefix_tokens.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. ``prefix_tokens[i]`` is the
    number of tokens of the first i code points, exactly as the library encodes them, from i = 0
    to the whole text. A null text counts as empty, its table is [0]. Rows are independent:
    repeated rows and rows without doc_id come out as they are, and the table of a very long text is
    as long as it. An empty table stays empty.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("prefix_tokens", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            ids, column = batch.column("doc_id").cast(pa.int64()), batch.column("text")
            first, size, tables, widths = 0, 0, [], []
            for k in range(len(column)):
                text = column[k].as_py() or ""
                tables.append(np.concatenate([[0], count.counts(text)]).astype(np.int32))
                widths.append(len(text.encode()))
                size += len(text)
                if size >= BATCH_CHARS or k == len(column) - 1:
                    ends = np.cumsum([0, *map(len, tables)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(ends, np.concatenate(tables))
                    yield pa.RecordBatch.from_arrays([ids[first : k + 1], pa.array(widths, pa.int64()), lists], schema=schema)
                    first, size, tables, widths = k + 1, 0, [], []

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, prefix_tokens array<int>")


def total(table: Column) -> Column:
    """Tokens of the whole text."""
    return F.element_at(table, -1).cast("long")


def longest_prefix(table: Column, budget: int | Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = F.transform(table, lambda n, i: F.when(n <= budget, i))
    return F.array_max(fits)


def token_counts(docs: DataFrame, limit: int = 512, vocabulary: str = VOCABULARY) -> DataFrame:
    """Bytes and tokens of every text and whether they pass ``limit``; see ``prefix_counts``."""
    n = total(F.col("prefix_tokens"))
    return prefix_counts(docs, vocabulary).select(
        "doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")
    )
