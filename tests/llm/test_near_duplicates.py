import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import awkward, groups, shingles
from tidegrid.llm import minhash, near_vectors
from tidegrid.llm.common import components


def edited(rng, base, share):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in base)


def texts():
    """Chains of edited copies, prefixes, case changes, and shared passages."""
    rng = random.Random(5)
    out = []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(3, 200))]
        out.append(" ".join(base))
        out.append("\t".join(base).upper())
        for share in (0.01, 0.02, 0.03, 0.05, 0.1):
            out += [edited(rng, base, share) for _ in range(4)]
        out.append(" ".join(base[: len(base) * 4 // 5]))
    passage = " ".join(f"p{k}" for k in range(40))
    out += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(n)) for n in range(0, 120, 3)]
    return out


def exact(rows):
    sets = [(i, frozenset(shingles(t))) for i, t in rows]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if x and y and 4 * len(x & y) >= 3 * len(x | y)
    ]
    return groups(links, [i for i, _ in rows]), dict((i, len(s)) for i, s in sets)


def test_components_of_edited_copies(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = minhash.near_duplicates(df).collect()
    want, sizes = exact(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_group_of_near_copies(spark):
    """Many near copies that are not all linked with each other, as in one hot bucket."""
    rng = random.Random(2)
    base = [f"b{k}" for k in range(120)]
    rows = list(enumerate([" ".join(w for w in base if rng.random() > rng.choice((0.005, 0.01, 0.03))) for _ in range(250)]))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == exact(rows)[0]


def test_awkward_documents(spark):
    got = sorted(map(tuple, minhash.near_duplicates(awkward(spark)).collect()), key=str)
    assert got == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 997, 4, True), (5, 997, 4, False),
            (6, 1, 6, True), (6, 1, 6, True), (None, 1, 6, False), (None, 0, None, True),
        ],
        key=str,
    )


def test_deduplicated_keeps_one_row_of_each_group(spark):
    docs = awkward(spark, ["alpha beta gamma delta epsilon zeta"] * 3)
    got = minhash.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted([1, 2, 3, 4, 6, 100, None], key=str)


def test_empty_table(spark):
    none = awkward(spark).limit(0)
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.deduplicated(none).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(30)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = groups(links, {i for e in links for i in e})
    linked = {i for a, b in links if a != b for i in (a, b)}
    assert {r.node: r.component for r in got} == {i: want[i] for i in linked}


def vector_rows():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 48))
    near = np.concatenate([b + rng.normal(size=(12, 48)) * np.linspace(0.05, 0.4, 12)[:, None] for b in base])
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(np.concatenate([near, rng.normal(size=(200, 48))]))]
    rows += [(1000 + k, rows[0][1]) for k in range(40)]  # equal vectors
    rows += [(2000, [float(2 * x) for x in rows[5][1]])]  # parallel
    return rows


def test_vectors_against_all_pairs(spark):
    rows = vector_rows()
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = [i for i, _ in rows]
    a, b = np.nonzero(np.triu(x @ x.T >= 0.95, 1))
    links = [(ids[i], ids[j]) for i, j in zip(a, b)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, node string, n_links int")
    got = near_vectors.near_vectors(df).collect()
    found = sum(r.n_links for r in got) / 2
    assert 0.9 * len(links) <= found <= len(links)
    want = groups(links, ids)
    assert np.mean([r.component_id == want[r.vec_id] for r in got]) > 0.95


def test_hot_list_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    monkeypatch.setattr(near_vectors, "BIN", 64)
    rng = np.random.default_rng(1)
    base = rng.normal(size=32)
    rows = [(k, [float(x) for x in base + rng.normal(size=32) * 0.02]) for k in range(150)]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(149, 0)}


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [1.0, 1.0]),
        (8, [2.0, 2.0]), (9, [1.0, 1.0, 1.0]), (10, [1e200, 1e200]), (7, [1.0, 1.0]), (None, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, near_vectors.near_vectors(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9)] + [(None, 0, None, True)]
    linked = [(7, 3, 7, True), (7, 3, 7, True), (8, 3, 7, False), (10, 3, 7, False)]
    assert got == sorted(alone + linked, key=str)
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_estimate_is_corrected_for_collisions(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(400)]
    rows = [(0, " ".join(base)), (1, edited(rng, base, 0.03)), (2, " ".join(f"z{k}" for k in range(400)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text"))
    signed = df.mapInArrow(minhash._sign, minhash._ddl())
    x, y = signed.alias("x"), signed.alias("y")
    got = x.crossJoin(y).select("x.doc_id", "y.doc_id", minhash.estimate("x", "y")).collect()
    sets = {i: set(shingles(t)) for i, t in rows}
    for a, b, e in got:
        assert abs(e - len(sets[a] & sets[b]) / len(sets[a] | sets[b])) < 0.16


def test_bins_of_blocks_count_copied_rows(spark, monkeypatch):
    """A bin holds about BIN rows however often its members are copied for the blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "BIN", 32)
    monkeypatch.setattr(minhash, "_block_links", lambda t: pa.table({"a": [t.num_rows], "b": pa.array([0], pa.int64())}))
    stray = spark.range(200).selectExpr("0L AS bucket", "id AS cls", "IF(id < 120, 0L, id) AS comp", "0L AS main", "0L AS guide")
    sets = stray.selectExpr("cls", "array(cls, cls + 1) AS shingles")
    assert max(r.a for r in minhash._unsettled(stray, sets).collect()) < 8 * 32


def test_bins_of_lists_count_copied_postings(spark, monkeypatch):
    """A bin holds about BIN rows however many blocks a hot list has."""
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    monkeypatch.setattr(near_vectors, "BIN", 64)
    size = lambda t: pa.table({"node": [t.num_rows], "links": pa.array([0], pa.int64()), "towards": pa.array([0], pa.int64())})
    monkeypatch.setattr(near_vectors, "_group_links", size)
    rng = np.random.default_rng(1)
    base = rng.normal(size=32)
    rows = [(k, [float(x) for x in base + rng.normal(size=32) * 0.02]) for k in range(300)]
    points = near_vectors.nodes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert max(r.node for r in near_vectors.links(points).collect()) < 8 * 64


def test_blocks_return_what_joins_components_only():
    """A dense group of strays gives fewer links than members, and they still join all of it."""
    n = 60
    lists = pa.array([[1 << 40, 2 << 40, 3 << 40, 4]] * 2 * n + [[1 << 40, 2 << 40, 7, 8]], pa.list_(pa.int64()))
    number = lambda x: pa.array(x, pa.int64())
    zero = number([0] * (2 * n + 1))
    ids = number(range(2 * n + 1))
    table = pa.table(
        {"main": zero, "i": zero, "j": zero, "cls": ids, "comp": ids, "side": pa.array([0] * n + [1] * (n + 1), pa.int32()), "tokens": lists}
    )
    links = [(r["a"], r["b"]) for r in minhash._block_links(table).to_pylist()]
    assert len(links) < 2 * n
    low = groups(links, range(2 * n + 1))
    assert {low[k] for k in range(2 * n)} == {0} and low[2 * n] == 2 * n


def test_strays_link_in_blocks(spark, monkeypatch):
    """Small blocks give the same components: copies of several passages that only the last step links."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "BIN", 16)
    rng = random.Random(2)
    base = [f"b{k}" for k in range(120)]
    rows = list(enumerate([" ".join(w for w in base if rng.random() > rng.choice((0.005, 0.01, 0.03))) for _ in range(60)]))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == exact(rows)[0]


def test_near_copies_without_id_link(spark):
    """A copy without doc_id bridges two documents; a group without any id keeps one row."""
    base = [f"w{k}" for k in range(60)]
    far = [f"x{k}" for k in range(60)]
    rows = [
        (7, " ".join([*(f"a{k}" for k in range(8)), *base])), (None, " ".join(base)), (9, " ".join([*base[:-10], "z1"])),
        (None, " ".join(far)), (None, " ".join([*far, "y1"])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [frozenset(shingles(t)) for _, t in rows]
    linked = [(a, b) for b in range(5) for a in range(b) if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    assert linked == [(0, 1), (1, 2), (3, 4)]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(7, 64, 7), (None, 56, 7), (9, 47, 7), (None, 56, None), (None, 57, None)}
    kept = minhash.deduplicated(docs).collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {7, None}
