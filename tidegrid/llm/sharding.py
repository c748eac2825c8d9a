"""Shards by a weighted hash tree.

A tree of regions, racks and shards holds the weights of its shards at the leaves; an inner node
weighs what its children weigh together. A key descends from the root: at each level every child
draws -ln(u) / weight with a u from a hash of the key and the child's name, and the smallest draw
wins. A child wins in proportion to its weight, and a draw depends on nothing but its own child.
So when a subtree's weight changes, keys move only into it (if it grew) or out of it (if it
shrank), level by level. A new shard that brings its own region takes keys only into itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import row_bytes

#: Groups that number the rows of a shard side by side: 16 to the power of this.
CHUNK_DIGITS = 3
#: Repeated rows are spread again in runs of this many.
RUN = 1 << 14


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. A leaf has a shard number and its own weight."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def leaves(node: Node) -> Iterator[Node]:
    if not node.children:
        yield node
    for c in node.children:
        yield from leaves(c)


def cluster(regions: int = 2, racks: int = 2, shards: int = 2) -> Node:
    """An even tree; shards are numbered from 0 in order."""
    out, k = [], 0
    for r in range(regions):
        row = []
        for c in range(racks):
            leaf = tuple(Node(f"r{r}.c{c}.s{k + i}", shard=k + i) for i in range(shards))
            k += shards
            row.append(Node(f"r{r}.c{c}", leaf))
        out.append(Node(f"r{r}", tuple(row)))
    return Node("root", tuple(out))


def with_shard(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own."""
    n, r = len(list(leaves(tree))), len(tree.children)
    leaf = Node(f"r{r}.c0.s{n}", shard=n, own_weight=weight)
    return Node(tree.name, (*tree.children, Node(f"r{r}", (Node(f"r{r}.c0", (leaf,)),))), None, tree.own_weight)


def draw(key: Column, node: Node) -> Column:
    """Exponential draw of a child: 52 bits of a hash make u; the smaller, the better."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(node.name), key)), 1, 13), 16, 10).cast("long")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**52))) / F.lit(float(node.weight))


def place(key: Column, node: Node) -> Column:
    """Shard of a key below ``node``. Ties go to the child named first in the tree."""
    if not node.children:
        return F.lit(node.shard)
    heirs = [c for c in node.children if c.weight > 0]
    if not heirs:
        raise ValueError(f"no weight below {node.name}")
    if len(heirs) == 1:
        return place(key, heirs[0])
    best = F.least(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(heirs)])["i"]
    out = place(key, heirs[-1])
    for i in reversed(range(len(heirs) - 1)):
        out = F.when(best == i, place(key, heirs[i])).otherwise(out)
    return out


def sharded(docs: DataFrame, tree: Node | None = None, key: str = "doc_id") -> DataFrame:
    """``docs`` with a ``shard`` column; no shuffle, any number of rows. A null key is the key "null".

    Rows with equal keys share a shard. A column named ``shard`` is replaced.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return docs.withColumn("shard", place(text, tree or cluster()).cast("int"))


def assignments(docs: DataFrame, tree: Node | None = None) -> DataFrame:
    """Shard and slot of every document, and its shard in a tree with one more shard.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null or empty text has size
    1; a null doc_id is the key "null"; repeated rows share a shard and get slots of their own.
    Slots of a shard run from 0 without gaps: rows are counted per (shard, chunk) of a hash of the
    row, chunks are laid end to end, and rows are numbered inside their chunk. Equal rows are
    counted before any shuffle and only spread at the end, so no row is too frequent. An empty
    table gives an empty result.
    """
    tree = tree or cluster()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (row_bytes(F.col("text").cast("string")) + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    kinds = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    keyed = kinds.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    placed = keyed.select(
        "doc_id",
        "size",
        "text_crc32",
        "copies",
        place(F.col("key"), tree).cast("int").alias("shard"),
        place(F.col("key"), with_shard(tree)).cast("int").alias("grown_shard"),
        F.substring(F.md5(F.concat_ws("|", "key", "size", "text_crc32")), 1, CHUNK_DIGITS).alias("chunk"),
    )
    # one row per shard and chunk: no more for more documents
    chunks = placed.groupBy("shard", "chunk").agg(F.sum("copies").alias("rows"))
    laid = chunks.selectExpr(
        "shard", "chunk", "coalesce(sum(rows) over (partition by shard order by chunk rows between unbounded preceding and 1 preceding), 0) as base"
    )
    inside = (
        "coalesce(sum(copies) over (partition by shard, chunk order by doc_id, size, text_crc32 "
        "rows between unbounded preceding and 1 preceding), 0) as before"
    )
    numbered = placed.selectExpr("*", inside).join(F.broadcast(laid), ["shard", "chunk"])
    first = F.col("base") + F.col("before")
    runs = numbered.select(
        "doc_id", "size", "text_crc32", "shard", "grown_shard", "copies", first.alias("first"),
        F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / RUN))).alias("run"),
    )
    begin = F.col("run") * RUN
    return runs.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(F.col("first") + begin, F.col("first") + F.least(begin + RUN, F.col("copies")) - 1)).alias("slot"),
        "grown_shard",
    )


def _sql_place(node: Node) -> str:
    if not node.children:
        return str(node.shard)
    if len(node.children) == 1:
        return _sql_place(node.children[0])

    def score(c: Node) -> str:
        return f"-ln((('0x' || substr(md5('{c.name}|' || k), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(2**52)!r}::DOUBLE) / {float(c.weight)!r}::DOUBLE"

    scores = ", ".join(score(c) for c in node.children)
    arms = " ".join(f"WHEN {i + 1} THEN {_sql_place(c)}" for i, c in enumerate(node.children))
    return f"(CASE list_position([{scores}], list_min([{scores}])) {arms} END)"


def oracle_sql(tree: Node | None = None) -> str:
    """The assignment in another engine's words, with the checksum worked out byte by byte."""
    tree = tree or cluster()
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ 0xEDB88320 if n & 1 else n >> 1
        table.append(n)
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(b)), "
        "lambda i: ('0x' || substr(hex(b), 2 * i + 1, 2))::BIGINT)), "
        f"lambda a, x: xor(a >> 8, ({table}::BIGINT[])[(xor(a, x) & 255) + 1])), 4294967295::BIGINT)"
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, encode(coalesce(text, '')) AS b FROM documents),
s AS (SELECT doc_id, k, octet_length(b)::BIGINT + 1 AS size, {crc} AS text_crc32,
      {_sql_place(tree)}::INTEGER AS shard, {_sql_place(with_shard(tree))}::INTEGER AS grown_shard FROM d)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard
  ORDER BY substr(md5(concat_ws('|', k, size, text_crc32)), 1, {CHUNK_DIGITS}), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM s"""
