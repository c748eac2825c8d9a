"""Ranked search against scores added up one by one."""

import math
import random
import re

import numpy as np
import pytest

from tests.llm.cases import FOLD, awkward
from tidegrid.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain_ranks(docs, items, top=10):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for doc, w in held:
            m = 25 + (75 * len(w) * n_docs) // n_terms
            total = 0
            for t in terms(text):
                tf = w.count(t)
                if tf:
                    total += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if total > 0:
                scores.append((-total, doc is None, doc, total))
        out += [(item, k, s[2], s[3]) for k, s in enumerate(sorted(scores, key=lambda s: s[:2] + (s[2] or 0,))[:top], 1)]
    return sorted(out, key=repr)


def corpus(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)] + ["Éa", "x1"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 60))) + rng.choice(["", "!", " W1"]) for _ in range(150)]
    docs = awkward(spark, [*texts, "same words here", "same words here", "SAME words, here"])
    items = spark.createDataFrame(
        [(k, " ".join(rng.choices(words, k=12)), "x") for k in range(40)]
        + [(900, "same words here", "x"), (900, "same", "x"), (None, "w1 w1 w2", "x"), (901, None, None), (902, " - ", None), (903, "unheard of", None), (904, "one two word1", None)],
        "item_id bigint, text string, doc_id string",
    )
    return docs, items


@pytest.mark.parametrize("cut", [None, 3_000_000])
def test_ranks_equal_plain_scores(spark, monkeypatch, cut):
    """Ties, repeats, missing ids; also with vocabularies cut in many parts and blocks of a few documents."""
    docs, items = corpus(spark)
    if cut:
        monkeypatch.setattr(ranked_search, "EXACT", cut * 1000)
        monkeypatch.setattr(ranked_search, "BLOCK_CELLS", 200)
        monkeypatch.setattr(ranked_search, "TILE_ITEMS", 7)
    got = sorted((tuple(r) for r in ranked_search.ranked(docs.repartition(5), items).collect()), key=repr)
    assert got == plain_ranks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_rounds_of_items_add_up(spark, monkeypatch):
    docs, items = corpus(spark)
    whole = sorted((tuple(r) for r in ranked_search.ranked(docs, items).collect()), key=repr)
    monkeypatch.setattr(ranked_search, "ROUND_BYTES", 2500)
    assert len(list(ranked_search._item_rounds(items))) > 1
    assert sorted((tuple(r) for r in ranked_search.ranked(docs, items).collect()), key=repr) == whole


def test_parts_stay_below_two_to_the_53():
    weight = np.full(4000, 30_000, np.int64)
    asked = [{f"t{k}".encode(): 1000 for k in range(4000)}]
    place = {f"t{k}".encode(): k for k in range(4000)}
    ((_, _, cuts, matrix),) = ranked_search._tiles(asked, place, weight)
    assert len(cuts) > 2
    assert all(matrix[:, a:b].sum() * ranked_search.MOST_IMPACT < 2**53 for a, b in zip(cuts, cuts[1:]))


def test_nothing_to_rank(spark):
    docs, items = corpus(spark)
    assert ranked_search.ranked(docs.limit(0), items).count() == 0
    assert ranked_search.ranked(docs, items.limit(0)).count() == 0
    assert ranked_search.ranked(docs.where("doc_id = 2"), items).columns == ["item_id", "rank", "doc_id", "score"]
