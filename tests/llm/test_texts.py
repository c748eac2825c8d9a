"""Operators that read whole texts in Python: counts, classifiers, extraction, decontamination."""

import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.cases import awkward, documents, shingles, words
from tidegrid.llm import decontaminate, extract, quality, textarrays, token_counts, toxicity

# --- word and shingle hashes -----------------------------------------------------------


def test_hashes_follow_words():
    texts = ["a b  c", "A\tB\nC", None, "", " \r\n", "a b c d e f", "x a b c d e", "é É", "abc", "ab c"] * 3
    raw, off = textarrays.text_buffers(pa.array(texts, pa.string()))
    hashes, counts, starts, ends = textarrays.word_hashes(raw, off)
    flat = [w for t in texts for w in words(t)]
    assert counts.tolist() == [len(words(t)) for t in texts]
    assert [bytes(raw[a:b]).decode().translate({c: c + 32 for c in range(65, 91)}) for a, b in zip(starts, ends)] == flat
    assert len(set(hashes.tolist())) == len(set(flat)) and len(set(zip(hashes.tolist(), flat))) == len(set(flat))
    got, n = textarrays.shingle_hashes(hashes, counts)
    want = [s for t in texts for s in shingles(t)]
    assert n.tolist() == [len(shingles(t)) for t in texts]
    assert len(set(zip(got.tolist(), want))) == len(set(want)) == len(set(got.tolist()))


def test_slices_cover_long_rows(monkeypatch):
    monkeypatch.setattr(textarrays, "SLICE_BYTES", 10)
    off = np.array([0, 3, 3, 50, 55, 58, 90])
    parts = list(textarrays.slices(off))
    assert parts[0][0] == 0 and parts[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


# --- token counts ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


def test_every_prefix_counts_as_the_library_does(library):
    rng = random.Random(3)
    parts = list("abetrs  \n\t'") + [
        "'re", "'ve", "'ll", "'s", "'r", " the", "ing", "é", "ñ", "日本", " ", " ", "😀", "12", "!!", "***",
        "<|endoftext|>", "<|end", "\r\n", "\x1c", "́", "ſ", "²",
    ]
    count = token_counts.counter()
    for _ in range(300):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        want = [len(library.encode(t[:i], add_special_tokens=False).ids) for i in range(1, len(t) + 1)]
        assert count.counts(t).tolist() == want, repr(t)


def test_tables_survive_a_full_store(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 5)
    count = token_counts.PrefixCounter(public_tokenizers.path(token_counts.VOCABULARY))
    t = " ".join(f"w{k % 13} it's" for k in range(60))
    assert count.counts(t)[-1] == len(library.encode(t, add_special_tokens=False).ids)


def test_token_counts_of_documents(spark, sf_dir, library):
    docs = spark.createDataFrame(documents(sf_dir), "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in token_counts.token_counts(docs).collect()}
    for i, text, _ in documents(sf_dir):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 512)


def test_budgets_need_no_encoding(spark, library):
    t = "The quick brown fox doesn't jump over 13 lazy dogs.  \n\nIt sleeps instead…"
    df = token_counts.prefix_counts(spark.createDataFrame([(1, t)], "doc_id long, text string"))
    cut = df.select(token_counts.longest_prefix(F.col("prefix_tokens"), 9)).first()[0]
    fits = [i for i in range(len(t) + 1) if len(library.encode(t[:i], add_special_tokens=False).ids) <= 9]
    assert cut == max(fits)


def test_awkward_token_counts(spark):
    docs = awkward(spark)
    got = token_counts.token_counts(docs).collect()
    assert len(got) == docs.count()
    assert sorted(r.n_tokens for r in got if r.n_bytes == 0) == [0, 0, 0]
    assert token_counts.token_counts(docs.limit(0)).count() == 0


# --- quality ---------------------------------------------------------------------------


def remainder(i, m):
    return zlib.crc32(str(i).encode()) % m


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_quality_on_held_out_documents(larger):
    docs, labels = larger
    trees = quality.train(docs, labels)
    rows = quality.scored(docs.join(labels.select("doc_id"), "doc_id"), trees).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows) and len(held) > 500
    assert np.mean([r.predicted == r.quality for r in held]) > 0.99


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES))).astype(np.float32)
    y = ((x[:, 3] > 0.2) ^ (x[:, 7] + 0.5 * x[:, 1] > 0)).astype(float)
    trees = quality.fit(x, y)
    walked = []
    for row in x:
        total = trees.base
        for t in range(quality.TREES):
            k = 0
            while trees.feature[t, k] >= 0:
                k = trees.left[t, k] + int(row[trees.feature[t, k]] > trees.threshold[t, k])
            total += trees.value[t, k]
        walked.append(1 / (1 + np.exp(-total)))
    assert np.allclose(trees.scores(x), walked)
    assert np.mean((trees.scores(x) > 0.5) == (y > 0)) > 0.9


def test_fit_without_a_choice():
    none = quality.fit(np.zeros((0, len(quality.FEATURES)), np.float32), np.zeros(0))
    assert none.scores(np.zeros((2, len(quality.FEATURES)), np.float32)).tolist() == [0.5, 0.5]
    ones = quality.fit(np.zeros((5, len(quality.FEATURES)), np.float32), np.ones(5))
    assert (ones.scores(np.zeros((2, len(quality.FEATURES)), np.float32)) > 0.9).all()


def test_awkward_quality(spark):
    docs = awkward(spark, ["Fine prose, of a kind."] * 3)
    labels = spark.createDataFrame(
        [(i, q, 0) for i, q in ((4, 1), (6, 0), (100, 1), (101, 1), (6, 1), (None, 1), (2, None))], "doc_id long, quality int, toxic int"
    )
    trees = quality.train(docs, labels)
    got = quality.scored(docs, trees).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    kept = quality.good(docs, trees)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.scored(docs.limit(0), trees).count() == 0
    assert quality.train(docs.limit(0), labels).scores(np.zeros((1, len(quality.FEATURES)), np.float32)) == 0.5


# --- toxicity --------------------------------------------------------------------------


def test_toxicity_on_held_out_documents(larger):
    docs, labels = larger
    model = toxicity.train(docs, labels)
    rows = toxicity.scored(docs.join(labels.select("doc_id"), "doc_id"), model).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in rows)
    toxic, plain = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    better = np.mean([[(a > b) + 0.5 * (a == b) for b in plain] for a in toxic])
    assert better > 0.93
    assert np.mean([s < 0.3 for s in plain]) > 0.97 and np.mean([s >= 0.3 for s in toxic]) > 0.7


def test_windows_hold_every_word():
    t = "Some words, and 12 more; a " + "long" * 40 + " one\nat the end " * 5
    parts = toxicity.windows(t)
    plain = "".join(c if c.isalpha() else " " for c in t.lower()).split()
    joined = [w for p in parts for w in p.decode().split()]
    assert set(joined) == set(plain)
    assert all(a.split()[-1] == b.split()[0] for a, b in zip(parts, parts[1:]) if len(a.split()) > 1)
    assert toxicity.windows(None) == toxicity.windows("12 ..") == []


def test_margins_are_what_the_dictionary_saves():
    model = toxicity.Model(b" plain words of the usual kind " * 20, b" quite horrible insult here ")
    assert max(model.margins("some plain words quite horrible insult here and there")) >= 3
    assert max(model.margins("plain words of the usual kind")) <= 0


def test_awkward_toxicity(spark):
    docs = awkward(spark, ["you horrible thing " * 3, "a nice thing to say"] * 6)
    labels = spark.createDataFrame([(100 + k, 1, 1 - k % 2) for k in range(12)] + [(None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = toxicity.scored(docs, toxicity.train(docs, known)).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    empty = {r.score for r in got if r.n_windows == 0}
    assert len(empty) == 1
    assert toxicity.scored(docs.limit(0), toxicity.Model(b"x", b"y", (0.0,) * toxicity.FEATURES)).count() == 0


# --- main text -------------------------------------------------------------------------

PARAGRAPH = "A paragraph of the article with a good many words, so that its density is high enough."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("just text", "just text"),
        (f"<body><nav><ul><li><a href=1>x</a></ul></nav><div id=content><p>{PARAGRAPH}<p>{PARAGRAPH}</div></body>", f"{PARAGRAPH}\n\n{PARAGRAPH}"),
        (
            f"<article><h1>T&eacute;st &amp; more</h1><p>{PARAGRAPH}<br>next&nbsp;line</p><section class='user-comments'><p>{PARAGRAPH}</p></section></article>",
            f"Tést & more\n\n{PARAGRAPH} next line",
        ),
        (f"<body><header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{PARAGRAPH}</p></main><aside><p>{PARAGRAPH}</p></aside></body>", f"Title\n\n{PARAGRAPH}"),
        (f"<div class=cookieNotice><p>{PARAGRAPH}</p></div><article><p>{PARAGRAPH}</p></article><form>{PARAGRAPH}</form>", PARAGRAPH),
        (f"<article><p>{PARAGRAPH}<script>if (a < b) '</p>'</script><!-- <p>x</p> --><b>bold<p>{PARAGRAPH}", f"{PARAGRAPH} bold\n\n{PARAGRAPH}".replace(". bold", ".bold")),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\n\ntwo\n\na\n\nb"),
        (f"<body><div><section><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></section><section><p>{PARAGRAPH} B</p><p>{PARAGRAPH} C</p></section></div></body>", "\n\n".join([PARAGRAPH, PARAGRAPH, PARAGRAPH + " B", PARAGRAPH + " C"])),
    ],
)
def test_main_text(page, text):
    assert extract.main_text(page) == text


def test_long_and_deep_pages():
    for tag in ("div", "span", "li"):
        deep = f"<{tag}>" * 50_000 + PARAGRAPH + f"</{tag}>" * 50_000
        start = time.perf_counter()
        assert extract.main_text(deep) == PARAGRAPH
        assert time.perf_counter() - start < 3
    many = "<body>" + "".join(f"<p>{PARAGRAPH} {k}</p>" for k in range(5000))
    assert extract.main_text(many).count("\n\n") == 4999


def test_extracted_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("text", F.lit("clash"))
    got = extract.extracted(pages.union(pages.limit(2))).collect()
    assert len(got) == pages.count() + 2
    assert all(r.n_chars == len(r.text) > 0 and "track(" not in r.text and "&amp;" not in r.text for r in got)
    odd = spark.createDataFrame([(None, None, None), (1, "u", "")], "page_id long, url string, html string")
    assert sorted(r.text for r in extract.extracted(odd).collect()) == ["", ""]
    assert extract.extracted(odd.limit(0)).count() == 0


# --- decontamination -------------------------------------------------------------------


def plain_matches(text, items):
    """Best weighted similarity of every item over all windows of its length."""
    w, out = words(text), {}
    for i, item in items:
        own = Counter(shingles(item))
        n = len(words(item))
        if not n or not w:
            continue
        best = 0.0
        for p in range(-3, max(len(w) - n, 0) + 4):
            window = w[max(p, 0) : max(p, 0) + n if p >= 0 else max(p + n, 0)]
            if window:
                seen = Counter(tuple(window[k : k + 5]) for k in range(max(1, len(window) - 4)))
                both = sum((own & seen).values())
                best = max(best, both / (sum(own.values()) + sum(seen.values()) - both))
        if best >= 0.75:
            out[i] = best
    return out


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(8)
    item = lambda n: [f"i{rng.randrange(3000)}" for _ in range(n)]
    items = [(k, item(rng.choice((5, 7, 12, 16, 25, 33, 45, 58, 300)))) for k in range(40)]
    texts = []
    for _ in range(160):
        _, w = rng.choice(items)
        w = list(w)
        for _ in range(rng.randint(0, 2)):
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = "zzz"
            elif len(w) > 3:
                w = w[1:] if rng.random() < 0.5 else w[:-1]
        body = item(rng.choice((0, 3, 80, 200)))
        p = rng.randint(0, len(body))
        texts.append("  ".join(body[:p] + w + body[p:]).title())
    texts += [" ".join(item(150)) for _ in range(40)]
    return [(k, " ".join(w)) for k, w in items], texts


def test_planted_passages(spark, planted):
    items, texts = planted
    want = {(k, i): s for k, t in enumerate(texts) for i, s in plain_matches(t, items).items()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([*items, (None, "x y z"), (90, None), (91, "")], "item_id long, text string")
    rows = decontaminate.contaminated(docs, bench).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in rows}
    assert len(want) > 80 and set(got) <= set(want)
    assert len(got) >= 0.95 * len(want)
    assert all(got[k] == pytest.approx(1) for k in want if want[k] == 1 and k in got)
    assert {k for k, s in want.items() if s == 1} <= set(got)
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {k for k, _ in got}


def test_items_in_several_passes(spark, planted, monkeypatch):
    items, texts = planted
    docs = spark.createDataFrame(list(enumerate(texts[:60])), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    key = lambda df: sorted(map(tuple, df.collect()))
    whole = key(decontaminate.contaminated(docs, bench))
    monkeypatch.setattr(decontaminate, "ITEMS_PER_PASS", 9)
    assert key(decontaminate.contaminated(docs, bench)) == whole


def test_every_fingerprint_within_the_radius_meets():
    rng = np.random.default_rng(5)
    size = decontaminate.Items([1], [" ".join(f"w{k}" for k in range(20))]).classes[0]
    own = size.prints
    flips = rng.integers(0, decontaminate.RADIUS + 1, 2000)
    near = np.array([own[k % len(own)] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, f, replace=False))) for k, f in enumerate(flips)])
    window, entry = size.meeting(near)
    assert {(k, k % len(own)) for k in range(2000)} <= set(zip(window.tolist(), entry.tolist()))
    assert (np.bitwise_count(near[window] ^ own[entry]) <= decontaminate.RADIUS).all()


def test_awkward_decontamination(spark):
    docs = awkward(spark, ["one two three"])
    bench = spark.createDataFrame([(1, "one two"), (2, "word5 word6 word7 word8 word9 word10"), (2, "one two")], "item_id long, text string")
    got = sorted(map(str, ((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())))
    want = [(d, i) for d in (6, 6, None, 100) for i in (1, 2)] + [(4, 2), (5, 2)]
    assert sorted(set(got)) == sorted(set(map(str, want)))
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()


def altered(rng, w, edits, how):
    w = list(w)
    for p in sorted(rng.sample(range(4, len(w) - 4), edits), reverse=True):
        if how == "replaced":
            w[p] = "zzz"
        elif how == "inserted":
            w.insert(p, "zzz")
        elif how == "left out":
            del w[p]
        else:  # the parts before and after change places
            w = w[p:] + w[:p]
    return w


@pytest.mark.parametrize("how", ["replaced", "inserted", "left out", "turned"])
@pytest.mark.parametrize("n, edits", [(13, 0), (32, 1), (39, 1), (45, 1), (80, 2), (110, 3), (150, 4), (300, 8)])
def test_every_passage_near_the_threshold_is_found(n, edits, how):
    """Items of one class with as many edits as leave a similarity of 0.75 to 0.85; also cut off by the end of a text."""
    rng = random.Random(n)
    item = lambda m: [f"i{rng.randrange(3000)}" for _ in range(m)]
    items = [(k, item(n if k % 2 else n + n // 6)) for k in range(30)]
    texts = []
    for k, (_, w) in enumerate(items * 2):
        w = altered(rng, w, edits if how != "turned" else min(edits, 2), how)
        body = item(60)
        if k % 5 == 4 and not edits:
            texts.append(" ".join(body + w[: len(w) - len(w) // 6]))
        else:
            texts.append(" ".join(body[:30] + w + body[30:]))
    want = {(r, r % 30): plain_matches(t, [(r % 30, " ".join(items[r % 30][1]))]).get(r % 30) for r, t in enumerate(texts)}
    want = {k: s for k, s in want.items() if s}
    if how == "replaced" and edits and n > 35:
        assert len(want) > 10 and min(want.values()) < 0.85
    raw, off = textarrays.text_buffers(pa.array(texts))
    filed = decontaminate.Items([k for k, _ in items], [" ".join(w) for _, w in items])
    assert {(r, k): s for r, k, s, _, _ in filed.matches(raw, off)} == pytest.approx(want)
    # the fingerprints of part windows do that by themselves
    filed.classes = []
    assert {(r, k): s for r, k, s, _, _ in filed.matches(raw, off)} == pytest.approx(want)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><p title=it's>{PARAGRAPH}</p><p>{PARAGRAPH} B</p></article>", f"{PARAGRAPH}\n\n{PARAGRAPH} B"),
        (f"<article><p onclick=foo('a\")>{PARAGRAPH}</p><p>{PARAGRAPH} B</p></article>", f"{PARAGRAPH}\n\n{PARAGRAPH} B"),
        (f"<article><p title = 'a > b' lang=en>{PARAGRAPH}</p><p title=\"x class=ad y\">{PARAGRAPH} B</p></article>", f"{PARAGRAPH}\n\n{PARAGRAPH} B"),
        (f"<article><p>{PARAGRAPH}</p><section class='reader-comments'><p>{PARAGRAPH} No!</p></section></article>", PARAGRAPH),
        (f"<body><div><p>{PARAGRAPH}</p><p>{PARAGRAPH} B</p></div><div class='feedback'><p>{PARAGRAPH} No!</p></div></body>", f"{PARAGRAPH}\n\n{PARAGRAPH} B"),
        (f"<body><main><p>{PARAGRAPH}</p></main><div class='discussion'><p>{PARAGRAPH} No!</p></div></body>", PARAGRAPH),
        (f"<body><div><p>{PARAGRAPH}</p><p>{PARAGRAPH} B</p></div><div class='bottom-legal'>Copyright of all, all rights reserved</div></body>", f"{PARAGRAPH}\n\n{PARAGRAPH} B"),
        (f"<body><main><p>{PARAGRAPH}</p><ul><li><a href=1>Related story one</a><li><a href=2>Related story two</a></ul></main></body>", PARAGRAPH),
        (f"<body><main><p>{PARAGRAPH} <a href=1>one</a> <a href=2>two</a></p><ul><li>A point with <a href=3>a link</a><li>and <a href=4>more</a></ul></main></body>", f"{PARAGRAPH} one two\n\nA point with a link\n\nand more"),
    ],
)
def test_probed_pages(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><article class='post has-sidebar'><p>{PARAGRAPH}</p></article></body>", PARAGRAPH),
        (f"<body><main class='no-sidebar'><p>{PARAGRAPH}</p></main><div class=sidebar>x y z</div></body>", PARAGRAPH),
        (f"<body><div id='content' class='widget-area'><p>{PARAGRAPH}</p></div></body>", PARAGRAPH),
        (f"<body><article class='category-advertising comment-open'><p>{PARAGRAPH}</p></article></body>", PARAGRAPH),
        (f"<body><article class=sidebar><p>{PARAGRAPH}</p></article></body>", PARAGRAPH),
        (f"<body><div class=widget><main><p>{PARAGRAPH}</p><div class=share-buttons>tell all</div></main></div></body>", PARAGRAPH),
        (f"<body><form id=aspnetForm><div class=menu><a href=1>one</a></div><div><p>{PARAGRAPH}</p></div></form></body>", PARAGRAPH),
        (f"<body><article><p>{PARAGRAPH}</p></article><div class=user-comments><p>{PARAGRAPH * 3}</p></div></body>", PARAGRAPH),
    ],
)
def test_names_alone_do_not_cut_the_article(page, text):
    assert extract.main_text(page) == text
