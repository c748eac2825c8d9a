"""Near-duplicate vectors through a pivot-permutation index.

Pivots are reference vectors drawn from the data. A vector is described by its SHARED nearest
pivots in order; every pivot keeps an inverted list of the vectors that name it. Vectors that share
at least AGREE pivots are candidates, and their cosine in double precision decides.

Lists are worked through in blocks of BLOCK vectors against BLOCK, so a list of any length is many
small tasks. A pair on several lists counts on the first one only. A block returns, per vector, its
number of links and one neighbour towards the smallest of its local group, so rows grow with the
postings, never with the pairs. Equal vectors are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import components, saved

COSINE = 0.95
#: Pivots a vector names, and how many two vectors must share. At a cosine of 0.95 in 64 dimensions
#: a pair shares two of eight among 1,024 pivots with probability 0.999.
NEAREST, AGREE = 8, 2
#: Pivots per root of the number of vectors, and their bounds: the index fits on the driver.
PER_ROOT, FEWEST, MOST = 4, 64, 4096
#: Pivots closer than this to an earlier one are passed over.
APART = 0.8
BLOCK = 1024
#: Rows of a bin of blocks.
BIN = 8192


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nodes(vectors: DataFrame) -> DataFrame:
    """(v, node, copies): the different usable vectors, their smallest vec_id and how many rows have them."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    usable = F.coalesce(
        (F.size("v") > 0) & F.forall("v", number) & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull(),
        F.lit(False),
    )
    return rows.where(usable).groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))


def pivots(points: DataFrame) -> dict[int, np.ndarray]:
    """Pivots by dimension, from a bounded sample: the points with the smallest hash, not too close together."""
    n = points.count()
    wanted = int(min(MOST, max(FEWEST, PER_ROOT * np.sqrt(n))))
    drawn = points.orderBy(F.xxhash64("node"), "node").limit(2 * wanted).select("v").collect()
    out: dict[int, np.ndarray] = {}
    for dim in {len(r[0]) for r in drawn}:
        x = _unit(np.array([r[0] for r in drawn if len(r[0]) == dim]))
        close = np.tril(x @ x.T, -1) > APART
        keep: list[int] = []
        for k in range(len(x)):
            if len(keep) < wanted and not close[k, keep].any():
                keep.append(k)
        out[dim] = x[keep]
    return out


def _pivots_of(known: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """Pivots of a dimension, filled up with seeded random directions where the sample has too few."""
    own = known.get(dim, np.zeros((0, dim)))
    if len(own) < NEAREST * 2:
        own = np.concatenate([own, _unit(np.random.default_rng(dim).normal(size=(FEWEST, dim)))])
    return own


def postings(points: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """The index: (dim, pivot, node, copies, named, v) for every pivot that a vector names, nearest first in ``named``."""
    schema = pa.schema(
        [("dim", pa.int32()), ("node", pa.int64()), ("copies", pa.int64()), ("named", pa.list_(pa.int32())), ("v", pa.list_(pa.float64()))]
    )
    shared = points.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                x = _unit(_matrix(part.column("v"), int(dim)))
                own = _pivots_of(shared.value, int(dim))
                near = np.argsort(-(x @ own.T), axis=1, kind="stable")[:, : min(NEAREST, len(own))].astype(np.int32)
                edges = np.arange(len(x) + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), dim, np.int32)),
                        part.column("node").cast(pa.int64()),
                        part.column("copies").cast(pa.int64()),
                        pa.ListArray.from_arrays(pa.array(edges * near.shape[1]), pa.array(near.ravel())),
                        pa.ListArray.from_arrays(pa.array(edges * int(dim)), pa.array(x.ravel())),
                    ],
                    schema=schema,
                )

    ddl = "dim int, node bigint, copies bigint, named array<int>, v array<double>"
    described = points.select("v", "node", "copies").mapInArrow(run, ddl)
    return described.select("dim", F.explode("named").alias("pivot"), "node", "copies", "named", "v")


def _group_links(table: pa.Table) -> pa.Table:
    """Links within a bin of blocks: per vector and block its link count and a smaller neighbour, or itself."""
    keys = np.stack([table.column(c).to_numpy() for c in ("dim", "pivot", "lo", "hi")])
    group = np.unique(keys, axis=1, return_inverse=True)[1].ravel()
    node, copies, upper = (table.column(c).to_numpy() for c in ("node", "copies", "upper"))
    named, v = table.column("named").combine_chunks(), table.column("v").combine_chunks()
    order = np.argsort(group, kind="stable")
    out_node, out_links, out_next = [], [], []
    for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        dim, pivot, lo, hi = keys[:, rows[0]]
        pick = pa.array(rows)
        x = _matrix(v.take(pick), int(dim))
        p = named.take(pick).flatten().to_numpy().reshape(len(rows), -1)
        kinds, place = np.unique(p, return_inverse=True)
        has = np.zeros((len(rows), len(kinds)), np.float32)
        has[np.arange(len(rows))[:, None], place.reshape(p.shape)] = 1
        a = np.flatnonzero(~upper[rows]) if lo != hi else np.arange(len(rows))
        b = np.flatnonzero(upper[rows]) if lo != hi else a
        if not len(a) or not len(b):
            continue
        earlier = kinds < pivot
        candidate = (has[a] @ has[b].T >= AGREE) & (has[a][:, earlier] @ has[b][:, earlier].T == 0)
        if lo == hi:
            candidate = np.triu(candidate, 1)
        i, j = np.nonzero(candidate)
        good = np.concatenate(
            [(x[a[i[s]]] * x[b[j[s]]]).sum(axis=1) >= COSINE for s in (slice(k, k + 65536) for k in range(0, len(i), 65536))]
            or [np.zeros(0, bool)]
        )
        i, j = rows[a[i[good]]], rows[b[j[good]]]
        if not len(i):
            continue
        one, two = np.concatenate([i, j]), np.concatenate([j, i])
        links = np.bincount(one, weights=copies[two], minlength=len(node)).astype(np.int64)
        towards = node.copy()
        while True:  # smallest node reachable inside the block
            before = towards.copy()
            np.minimum.at(towards, one, before[two])
            if (towards == before).all():
                break
        own = np.unique(one)
        out_node.append(node[own])
        out_links.append(links[own])
        out_next.append(towards[own])
    cat = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
    return pa.table({"node": cat(out_node), "links": cat(out_links), "towards": cat(out_next)})


def links(points: DataFrame) -> DataFrame:
    """(node, links, towards): link counts per block, and edges that keep every local group connected."""
    index = saved(postings(points, pivots(points)))
    lists = index.groupBy("dim", "pivot").agg(F.count("*").alias("n"))  # at most MOST rows per dimension
    lists = lists.withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    cut = index.join(lists.drop("n"), ["dim", "pivot"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    placed = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    # every posting is placed once for each block of its list
    bins = (lists.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0) // BIN + 1
    block = placed.select(
        "dim", "pivot", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).alias("upper"), "node", "copies", "named", "v",
    )
    return block.withColumn("bin", F.pmod(F.xxhash64("dim", "pivot", "lo", "hi"), F.lit(bins))).groupBy("bin").applyInArrow(
        _group_links, "node bigint, links bigint, towards bigint"
    )


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Links and components of near-equal vectors: vec_id, n_links, component_id, kept.

    ``vectors`` has ``vec_id`` and ``embedding``, an array of numbers; other columns are ignored.
    Vectors of one length are linked when their cosine is 0.95 or more. A vector that is null,
    empty, all zero or holds a null or a non-finite component links with nothing, and so does a row
    without vec_id. Rows with equal vectors are linked to each other; rows that repeat a vec_id
    count as rows and share its component. An empty table gives an empty result.
    """
    points = saved(nodes(vectors))
    found = saved(links(points))
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("towards").alias("b")))
    point = (
        points.join(count, "node", "left")
        .join(joined, "node", "left")
        .select(
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(F.col("vec_id").isNotNull(), F.col("v")))
    out = rows.join(point, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def oracle_sql() -> str:
    """All pairs compared, and links followed to the smallest vec_id."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}::DOUBLE),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(vec_id, m), vec_id) AS component_id,
  coalesce(vec_id <= m, true) AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, min(b) AS m FROM r GROUP BY a) USING (vec_id)"""
