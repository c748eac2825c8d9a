"""Periodic runs: against a search of every period, on the query's own rules."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.cases import WORD, awkward
from tidegrid.llm import runs
from tidegrid.llm.queries import op11_runs


def plain_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in out.items())


def plain_row(doc_id, text, planted=True):
    words = WORD.findall(text or "")
    n = len(words)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, q, e in found for i in range(s + q, e)}
    best = min(((-(e - s), s, q) for s, q, e in found), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def some_words(rng, n):
    k = rng.choice([1, 2, 2, 3, 40])
    out = []
    while len(out) < n:
        part = [f"w{rng.randrange(k)}" for _ in range(rng.choice([1, 2, 3, 5, 9, 17, 33]))]
        out += (part * rng.choice([1, 3, 4, 5, 8]))[: rng.randrange(1, 200)]
    return out[:n]


@pytest.mark.parametrize("block", [2048, 4, 8])
def test_runs_equal_those_of_every_period(monkeypatch, block):
    """Small blocks send long periods through the scales that look at parts of a block only."""
    monkeypatch.setattr(runs, "BLOCK", block)
    for cached in (runs._primes, runs._transform):
        cached.cache_clear()
    rng = random.Random(block)
    for _ in range(25):
        docs = [some_words(rng, rng.choice([0, 1, 6, 40, 150, 400])) for _ in range(8)]
        ids, ends = [], []
        want = []
        for d in docs:
            seen = {}
            want += [(s + len(ids), q, e + len(ids)) for s, q, e in plain_runs(d)]
            ids += [seen.setdefault(w, len(seen)) for w in d]
            ends.append(len(ids))
        s, e, q = runs.runs_of(np.array(ids, np.int64), np.array(ends))
        assert list(zip(s.tolist(), q.tolist(), e.tolist())) == want
    for cached in (runs._primes, runs._transform):
        cached.cache_clear()


@pytest.mark.parametrize("block", [1, 2, 32, 64, 512, 2048])
def test_transform_is_exact(block):
    """Squared differences modulo a prime, against plain sums of large words."""
    rng = np.random.default_rng(block)
    ids = rng.integers(0, 50_000, 6 * block)
    ids[3 * block + block // 2 : 4 * block + block // 2] = ids[:block]
    row, offset = runs._equal_blocks(ids, np.array([0, 0]), np.array([block, 3 * block]), block)
    want = [
        (r, d) for r, b in enumerate((block, 3 * block)) for d in range(block) if (ids[b + d : b + d + block] == ids[:block]).all()
    ]
    assert sorted(zip(row.tolist(), offset.tolist())) == want and (1, block // 2) in want


def test_very_long_texts_take_linear_work():
    for ids in (np.zeros(400_000, np.int64), np.r_[np.zeros(200_000, np.int64), 1, np.zeros(199_999, np.int64)]):
        start, end, period = runs.runs_of(ids, np.array([len(ids)]))
        assert period.tolist() == [1] * len(start) and (end - start).sum() >= 399_999


def test_query_on_awkward_documents(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(some_words(rng, rng.choice([5, 30, 300]))) for _ in range(60)] + ["a\x0bb\x1ca " * 9, "é é é é é é", "A a A a A a"]
    docs = awkward(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op11_runs(spark, str(tmp_path)).collect()), key=repr)
    # the very long text repeats 997 words; its runs are known without a search of every period
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    short = [plain_row(i, t) for i, t in rows if len(t or "") < 100_000]
    assert [r for r in got if r[0] not in (4, 5)] == sorted(short, key=repr)
    long = [r for r in got if r[0] in (4, 5)]
    assert all(r[1] == 1 and r[2:6] == (0, 30_000, 997, 30_090) for r in long)
    assert runs.digest(runs.periodic_runs(docs.limit(0))).count() == 0


def test_runs_and_kept_words_of_the_operator(spark):
    docs = spark.createDataFrame([(1, "x " + "a b " * 5 + "y"), (2, "z z z z z")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(1, 10, 2)] and rows[1].kept == "x a b y" and rows[1].n_words == 12
    assert rows[2].runs == [] and rows[2].kept == "z z z z z"
    assert re.fullmatch("[a-z ]+", rows[1].kept)
