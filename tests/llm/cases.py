"""Small tables with the awkward rows, and plain versions to compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, size int, score string"


def awkward(spark, texts=()):
    """Documents with nulls, empty, blank and very long texts, repeats, and columns whose names clash."""
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, None, "en", "b", None, "x", 1, None),
        (2, "", None, None, 0, None, None, None),
        (3, " \t\n ", "en", "a", 4, None, None, "s"),
        (4, long, "en", "a", len(long), None, None, None),
        (5, long, "en", "a", len(long), None, None, None),
        (6, "one two", "en", "b", 7, None, None, None),
        (6, "one two", "en", "b", 7, None, None, None),
        (None, "ONE two", None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
        *[(100 + k, t, "en", f"s{k % 3}", len(t), None, None, None) for k, t in enumerate(texts)],
    ]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def shingles(text):
    w = words(text)
    return [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []


def groups(links, ids):
    """Smallest id that each id reaches."""
    low = {i: i for i in ids}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


def documents(folder):
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text, source FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
