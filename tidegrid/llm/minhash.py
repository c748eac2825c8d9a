"""Near-duplicate documents by b-bit MinHash.

Each distinct shingle set gets 256 minima. Bands of four full minima propose candidates; the low
two bits of all minima, packed into eight longs, estimate the similarity of a candidate by bit
counts, corrected for chance collisions; what may reach the threshold is decided on the full sets.
At the threshold itself (0.75) a pair shares none of the 32 bands with probability 5e-6.

Groups of copies cost no pairs: equal sets are one class from the start. Within a bucket of a band
each member is first compared with one leader, another one in every bucket; then members outside
the bucket's main component with one of its members; and at last members outside the main
component with everyone, in blocks that return as many links as join what the block joins. A large
group of near copies is joined by the first two, which are linear in its size, while no pair of different components that shares
a bucket is left undecided.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import LOWER, UPPER, WORD, components, saved
from tidegrid.llm.textarrays import mixed, shingle_hashes, slices, text_buffers, word_hashes

HASHES, BITS = 256, 2
BANDS, ROWS = 32, 4
THRESHOLD = (3, 4)  # similarity as a fraction: 0.75
#: How far an estimate may fall short: five standard deviations of a 2-bit estimate at 0.75.
MARGIN = 0.16
#: Members of a block, and rows of a bin of blocks, in the last comparison.
BLOCK, BIN = 512, 4096
#: Shingles of the members of a block, and of the rows of a bin of blocks: long texts make smaller ones.
BLOCK_SHINGLES, BIN_SHINGLES = 1 << 19, 1 << 22

#: Members that make a component hot, and hot components whose rows are broadcast.
HOT, HOT_MAINS = BLOCK, 100_000

_rng = np.random.default_rng(7)
_A = _rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_BAND = _rng.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def _minima(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """(rows, HASHES) smallest value of each hash function over each row's shingles."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(begins), HASHES), np.uint32)
    value = np.empty_like(x)
    for k in range(HASHES):
        np.multiply(x, _A[k], out=value)
        value += _B[k]
        out[:, k] = np.minimum.reduceat(value, begins)
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    """Low BITS bits of each minimum, packed into longs."""
    low = (minima & np.uint32(2**BITS - 1)).astype(np.uint64)
    per = 64 // BITS
    shifts = (np.arange(per) * BITS).astype(np.uint64)
    return (low.reshape(len(low), HASHES // per, per) << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)


def _sets(column: pa.Array) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Distinct shingle hashes of each text, sorted, by slices of rows."""
    raw, off = text_buffers(column)
    for first, last in slices(off):
        words, counts, _, _ = word_hashes(raw, off[first : last + 1])
        hashes, n = shingle_hashes(words, counts)
        ends = np.cumsum(n)
        yield slice(first, last), [np.unique(hashes[e - k : e]) for e, k in zip(ends, n)]


def _digest(values: np.ndarray) -> int | None:
    """Key of a set's class; n different sets share a key with probability n * n / 2**65."""
    if not len(values):
        return None
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64())]
    + [(f"s{k}", pa.int64()) for k in range(HASHES * BITS // 64)]
    + [("bands", pa.list_(pa.int64()))]
)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, sets in _sets(batch.column("text")):
            sizes = np.array([len(s) for s in sets], np.int64)
            sig = np.zeros((len(sets), HASHES * BITS // 64), np.int64)
            keys = np.zeros((len(sets), BANDS), np.int64)
            full = np.flatnonzero(sizes)
            if len(full):
                minima = _minima(np.concatenate([sets[i] for i in full]), np.cumsum(sizes[full]) - sizes[full])
                sig[full] = _packed(minima)
                folded = (minima[:, : BANDS * ROWS].reshape(len(full), BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64)
                keys[full] = mixed(folded + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            bands = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32), keys[full].ravel()
            )
            ids, hashes = (batch.column(c)[rows.start : rows.stop].cast(pa.int64()) for c in ("doc_id", "text_hash"))
            longs = [pa.array(np.ascontiguousarray(sig[:, k])) for k in range(sig.shape[1])]
            digests = pa.array([_digest(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, hashes, pa.array(sizes), digests, *longs, bands], schema=SIGNED)


FULL = pa.schema([("cls", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the wanted classes; a row whose text is not of its class is passed over."""
    for batch in batches:
        wanted = batch.column("cls").to_pylist()
        for rows, sets in _sets(batch.column("text")):
            keep = [(c, s.view(np.int64)) for c, s in zip(wanted[rows], sets) if _digest(s) == c]
            if keep:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in keep], pa.int64()), pa.array([s for _, s in keep], pa.list_(pa.int64()))],
                    schema=FULL,
                )


def estimate(a: str, b: str):
    """Similarity of two packed signatures: the share of equal lanes, less chance collisions."""
    lanes = 0x5555555555555555
    unequal = sum(
        F.bit_count(
            F.expr(f"({a}.s{k} ^ {b}.s{k} | shiftrightunsigned({a}.s{k} ^ {b}.s{k}, 1)) & {lanes}L")
        )
        for k in range(HASHES * BITS // 64)
    )
    chance = 2.0**-BITS
    return ((F.lit(float(HASHES)) - unequal) / HASHES - chance) / (1 - chance)


def _may_link(a: str, b: str):
    """Whether two signed sets can reach the threshold, by their sizes and their estimate."""
    num, den = THRESHOLD
    fewer, more = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (den * fewer >= num * more) & (estimate(a, b) >= num / den - MARGIN)


def _ordered(rows: DataFrame, one: str, two: str) -> DataFrame:
    return rows.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))


def _near(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    return (
        pairs.join(signed.alias("x"), F.col("a") == F.col("x.cls"))
        .join(signed.alias("y"), F.col("b") == F.col("y.cls"))
        .where(_may_link("x", "y"))
        .select("a", "b")
    )


def _stars(joined: DataFrame) -> DataFrame:
    return joined.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def _strays(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Members (bucket, cls, comp, main, guide) of the buckets that hold several components.

    ``main`` is the component with most members there, ``guide`` one of its members.
    """
    label = shared.join(joined, shared["cls"] == joined["node"], "left").select(
        "bucket", "cls", F.coalesce("component", "cls").alias("comp")
    )
    per = label.groupBy("bucket", "comp").agg(
        F.count("*").alias("n"), F.min(F.struct(F.xxhash64("cls", "bucket"), "cls"))["cls"].alias("one")
    )
    mixed_up = (
        per.groupBy("bucket")
        .agg(F.max(F.struct("n", "comp", "one")).alias("top"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("bucket", F.col("top.comp").alias("main"), F.col("top.one").alias("guide"))
    )
    return label.join(mixed_up, "bucket")


def _laid(of: DataFrame, per: DataFrame, n_hot: int) -> DataFrame:
    """Members with the blocks of their main component; no join key holds more than HOT members.

    A component with more than HOT members here is one row for at least that many. These rows are
    sent to the members, while there are at most HOT_MAINS of them; if there are more, no single one
    is large against all members, and the plain join is dealt evenly or split at run time.
    """
    wide = of.select("main", "cls", "comp", "outside")
    blocks = per.select("main", "rows", "cols", "every")
    if n_hot > HOT_MAINS:
        return wide.join(blocks.drop("every"), "main")
    few = F.broadcast(blocks.where(F.col("every") > HOT).drop("every"))
    marked = wide.join(few, "main", "left")
    cold = blocks.where(F.col("every") <= HOT).select("main", F.col("rows").alias("r"), F.col("cols").alias("c"))
    rest = marked.where("rows IS NULL").drop("rows", "cols").join(cold, "main")
    return marked.where("rows IS NOT NULL").unionByName(rest.withColumnsRenamed({"r": "rows", "c": "cols"}))


def _unsettled(stray: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components that members of mixed buckets still join.

    Members are laid out by the main component of their bucket, once however many buckets they
    share: those outside it in blocks against blocks of all members. A task counts the shingles
    that the full sets of two blocks share and decides; it returns fewer links than the block has
    components, so rows grow with the members placed, never with the pairs.
    """
    of = saved(
        stray.groupBy("main", "cls")
        .agg(F.first("comp").alias("comp"))
        .withColumn("outside", F.col("comp") != F.col("main"))
        .join(sets.select("cls", F.size("shingles").cast("long").alias("n")), "cls")
    )
    few, long = F.col("outside").cast("long"), F.when(F.col("outside"), F.col("n")).otherwise(0)
    blocks = lambda rows, n: F.greatest(F.lit(1), F.ceil(rows / BLOCK), F.ceil(n / BLOCK_SHINGLES))
    per = saved(
        of.groupBy("main")
        .agg(F.sum(few).alias("few"), F.count("*").alias("every"), F.sum(long).alias("few_n"), F.sum("n").alias("every_n"))
        .withColumns({"rows": blocks(F.col("few"), F.col("few_n")), "cols": blocks(F.col("every"), F.col("every_n"))})
    )
    # what all blocks hold together: every member once for each block of the other side
    held = per.agg(
        F.sum(F.expr("few * cols + every * rows")), F.sum(F.expr("few_n * cols + every_n * rows")), F.count_if(F.col("every") > HOT)
    ).first()
    bins = max((held[0] or 0) // BIN, (held[1] or 0) // BIN_SHINGLES) + 1
    laid = _laid(of, per, held[2])
    own = F.pmod(F.xxhash64("cls"), F.col("rows"))
    sides = laid.where("outside").select(
        "main", "cls", "comp", F.lit(0).alias("side"), own.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1)).alias("j")
    ).union(
        laid.select(
            "main", "cls", "comp", F.lit(1).alias("side"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("i"), F.pmod(F.xxhash64("cls"), F.col("cols")).alias("j"),
        )
    )
    placed = sides.join(sets.select("cls", F.col("shingles").alias("tokens")), "cls").withColumn(
        "bin", F.pmod(F.xxhash64("main", "i", "j"), F.lit(bins))
    )
    return placed.groupBy("bin").applyInArrow(_block_links, "a bigint, b bigint").distinct()


def _block_links(table: pa.Table) -> pa.Table:
    """Links (a, b) that join the components which the two sides of every block in a bin connect."""
    block = np.stack([table.column(c).to_numpy() for c in ("main", "i", "j")])
    group = np.unique(block, axis=1, return_inverse=True)[1].ravel()
    comp, side = (table.column(c).to_numpy() for c in ("comp", "side"))
    lists = table.column("tokens").combine_chunks()
    values, off = lists.values.to_numpy(), lists.offsets.to_numpy()
    num, den = THRESHOLD
    found: list[tuple[int, int]] = []
    order = np.argsort(group, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        left, right = rows[side[rows] == 0], rows[side[rows] == 1]
        if not len(left) or not len(right):
            continue
        sizes = off[right + 1] - off[right]
        tokens = np.concatenate([values[off[r] : off[r + 1]] for r in right])
        owner = np.repeat(np.arange(len(right)), sizes)
        sort = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[sort], owner[sort]
        kinds, place = np.unique(comp[np.concatenate([left, right])], return_inverse=True)
        own, other = place[: len(left)], place[len(left) :]
        joined = np.arange(len(kinds))  # components that are known to be one
        for r, k in zip(left, own):
            if (joined[other] == joined[k]).all():
                continue
            mine = values[off[r] : off[r + 1]]
            lo, hi = np.searchsorted(tokens, mine, "left"), np.searchsorted(tokens, mine, "right")
            n = hi - lo
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            common = np.bincount(owner[at], minlength=len(right))
            linked = other[den * common >= num * (len(mine) + sizes - common)]
            for c in np.unique(linked):
                if joined[c] != joined[k]:
                    found.append((min(int(kinds[k]), int(kinds[c])), max(int(kinds[k]), int(kinds[c]))))
                    joined[joined == joined[c]] = joined[k]
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"a": pa.array(np.ascontiguousarray(a)), "b": pa.array(np.ascontiguousarray(b))})


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    num, den = THRESHOLD
    one = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return pairs.join(one, "a").join(two, "b").where(den * common >= num * union).select("a", "b")


def _grouped(docs: DataFrame) -> DataFrame:
    """Every row with its component: doc_id, text_hash, n_shingles, cls, comp, name (its smallest doc_id)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = saved(rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(_sign, _ddl()))
    sig = [f"s{k}" for k in range(HASHES * BITS // 64)]
    classes = saved(
        signed.where("cls is not null")
        .groupBy("cls")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("rep"),
            F.first("n_shingles").alias("n"),
            *[F.first(s).alias(s) for s in sig],
            F.first("bands").alias("bands"),
        )
    )
    entries = classes.select(F.explode("bands").alias("bucket"), "cls")
    draw = F.struct(F.xxhash64("bucket", "cls"), F.col("cls").alias("cls"))
    buckets = entries.groupBy("bucket").agg(F.min(draw)["cls"].alias("lead"), F.count("*").alias("n"))
    shared = saved(entries.join(buckets.where("n > 1").select("bucket", "lead"), "bucket"))
    sets = saved(_wanted_sets(rows, classes, shared))
    s = classes.select("cls", "n", *sig)

    def checked(pairs: DataFrame) -> DataFrame:
        return saved(confirmed(_near(pairs, s), sets))

    links = checked(_ordered(shared.where("cls != lead"), "cls", "lead").distinct())
    joined = components(links)
    stray = _strays(shared, joined)
    again = checked(_ordered(stray.where("comp != main"), "cls", "guide").distinct())
    links = saved(_stars(joined).union(again))
    joined = components(links)
    stray = _strays(shared, joined)
    late = saved(_unsettled(stray, sets))
    groups = joined if late.isEmpty() else components(_stars(joined).union(late))

    member_of = classes.join(groups, classes["cls"] == groups["node"], "left").select(
        "cls", F.col("rep.doc_id").alias("rep"), F.coalesce("component", "cls").alias("comp")
    )
    # a component whose rows all lack an id has no name
    names = member_of.groupBy("comp").agg(F.min("rep").alias("name"))
    named_as = member_of.join(names, "comp").select("cls", "comp", "name")
    return signed.select("doc_id", "text_hash", "n_shingles", "cls").join(named_as, "cls", "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Component of near-duplicate documents for each row: doc_id, n_shingles, component_id, kept.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Documents are linked when
    the Jaccard similarity of their distinct five-word shingles is 0.75 or more; components are
    what links reach. Null, empty and wordless texts have no shingles and link with nothing.
    Repeated rows stay repeated, in one component. A row without doc_id links as any other
    but never names a component; if no row of a component has an id, component_id is null
    and the row is kept. Very long texts give all their shingles. An empty table gives an empty
    result.
    """
    component = F.coalesce("name", F.when(F.col("cls").isNull(), F.col("doc_id")))
    return _grouped(docs).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, with its columns, and all rows without words.

    The row with the smallest doc_id stays, of equal ids the one with the smallest hash of its text.
    """
    per = _grouped(docs).where("cls is not null").groupBy("comp", "doc_id", "text_hash").agg(F.count("*").alias("m"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "m"))
    keep = saved(per.groupBy("comp").agg(first.alias("k")).select("k.doc_id", "k.text_hash", "k.m"))

    def rows_of(kept: DataFrame) -> DataFrame:
        same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.doc_id"))
        return docs.alias("d").join(
            kept.alias("k"), same & (F.xxhash64(F.col("d.text").cast("string")) == F.col("k.text_hash")), "left_semi"
        )

    has_words = F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    out = rows_of(keep.where("m = 1")).where(has_words).union(docs.where(~has_words))
    many = keep.where("m > 1")
    if many.isEmpty():
        return out
    return out.union(rows_of(many).where(has_words).dropDuplicates(["doc_id", "text"]))


def _ddl() -> str:
    longs = ", ".join(f"s{k} bigint" for k in range(HASHES * BITS // 64))
    return f"doc_id bigint, text_hash bigint, n_shingles bigint, cls bigint, {longs}, bands array<bigint>"


def _wanted_sets(rows: DataFrame, classes: DataFrame, shared: DataFrame) -> DataFrame:
    """Full sets of the classes that share a bucket, from one representative text each."""
    wanted = shared.select("cls").distinct().join(classes.select("cls", "rep"), "cls").alias("w")
    text = rows.alias("r").join(
        wanted,
        F.col("r.doc_id").eqNullSafe(F.col("w.rep.doc_id")) & (F.xxhash64("r.text") == F.col("w.rep.text_hash")),
    )
    return text.select("cls", "text").mapInArrow(_full_sets, "cls bigint, shingles array<bigint>").dropDuplicates(["cls"])


def oracle_sql() -> str:
    """Exact similarities of all pairs that share a shingle, and links followed to the smallest doc_id."""
    num, den = THRESHOLD
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
u AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, coalesce(least(doc_id, m), doc_id) AS component_id, coalesce(doc_id <= m, true) AS kept
FROM s LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) USING (doc_id)"""
