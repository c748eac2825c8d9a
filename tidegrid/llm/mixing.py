"""Mixing sources to target weights by dependent rounding.

Every document of a source is owed the same number of copies, target / source size. The whole part
is given outright. The fraction is a copy probability, and the probabilities of a source are
rounded together: two documents at a time pass word mass to each other, at random and without
bias, until one of them is settled at 0 or 1. Each transfer keeps the words expected from the pair,
so a source's taken words miss its target by at most half of one document.

The rounding is a reduction tree. Rows fall by hash into chunks of about FAN per source, each chunk
is folded to at most one unsettled document, and those are the rows of the next level, until one
per source is left, which goes to the nearer side. Folds go from long to short documents: the many
short ones settle the long ones, so what is left over is short. All of it runs as DataFrame functions; random
numbers are hashes of the documents involved, so a rerun takes the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import saved, words

#: Expected rows of a chunk.
FAN = 32
#: The most copies of a document, and the cap of a target in source sizes.
MOST = 3
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)

ITEM = "struct<doc_id:bigint,copy:bigint,size:bigint,p:double>"
DONE = "struct<doc_id:bigint,copy:bigint,size:bigint,extra:int>"


def targets(sizes: DataFrame) -> DataFrame:
    """Target of each source: (source, source_size, rows, target).

    ``sizes`` has ``source``, ``size`` and ``rows`` (how many such rows). Weights go to sources by
    code point, null last. A source whose share of all words would pass MOST times its own words
    stops there, and the rest is shared by weight among the others until none is above. One row
    per source is ranked in one task; rows of documents are only summed.
    """
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("rows")
    )
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") - 1) % len(WEIGHTS) + 1)
    ranked = totals.selectExpr("*", "row_number() over (order by source asc nulls last) as rank").select(
        "source", "source_size", "rows", weight.alias("weight"), "rank", (F.col("source_size") * MOST).alias("cap")
    )
    # sources reach their cap in the order of cap / weight
    order = "order by cap / weight, rank"
    level = ranked.selectExpr(
        "*",
        "sum(source_size) over () as total",
        f"coalesce(sum(cap) over ({order} rows between unbounded preceding and 1 preceding), 0) as capped",
        f"sum(weight) over ({order} rows between current row and unbounded following) as open",
    ).withColumn("full", F.col("weight") * (F.col("total") - F.col("capped")) >= F.col("cap") * F.col("open"))
    shared = level.selectExpr(
        "source", "source_size", "rows", "weight", "cap", "full", "total",
        "sum(if(full, cap, 0)) over () as spent", "sum(if(full, 0D, weight)) over () as left",
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap"), (F.col("total") - F.col("spent")) * F.col("weight") / F.col("left"))
    )
    return shared.select("source", "source_size", "rows", F.coalesce(target, F.lit(0.0)).alias("target"))


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _fold(items: Column, level: int) -> Column:
    """Settle a chunk: struct(open: at most one unsettled item, done: the settled ones).

    ``items`` is ordered. With word masses s * p, the held item i and the next item j can move
    ``up`` words from j to i or ``down`` words from i to j before one of them is at 0 or 1; moving
    up with probability down / (up + down) leaves both probabilities unbiased.
    """

    def settled(item, extra):
        return F.struct(
            item["doc_id"].alias("doc_id"), item["copy"].alias("copy"), item["size"].alias("size"),
            extra.cast("int").alias("extra"),
        )

    def moved(item, p):
        return F.struct(
            item["doc_id"].alias("doc_id"), item["copy"].alias("copy"), item["size"].alias("size"), p.alias("p")
        )

    none, no_items = F.array().cast(f"array<{DONE}>"), F.array().cast(f"array<{ITEM}>")

    def step(state, j):
        i = state["open"][0]
        give_i, take_i = i["size"] * i["p"], i["size"] * (1 - i["p"])
        give_j, take_j = j["size"] * j["p"], j["size"] * (1 - j["p"])
        up, down = F.least(take_i, give_j), F.least(give_i, take_j)
        rise = _unit(i["doc_id"], i["copy"], i["size"], j["doc_id"], j["copy"], j["size"], F.lit(level)) * (up + down) < down
        new_i = (
            F.when(rise, F.when(take_i <= give_j, 1.0).otherwise(i["p"] + up / i["size"]))
            .otherwise(F.when(give_i <= take_j, 0.0).otherwise(i["p"] - down / i["size"]))
        )
        new_j = (
            F.when(rise, F.when(give_j <= take_i, 0.0).otherwise(j["p"] - up / j["size"]))
            .otherwise(F.when(take_j <= give_i, 1.0).otherwise(j["p"] + down / j["size"]))
        )
        pair = F.array(moved(i, new_i), moved(j, new_j))
        is_open = lambda x: (x["p"] > 0) & (x["p"] < 1)
        both = F.struct(
            F.filter(pair, is_open).alias("open"),
            F.concat(
                state["done"], F.transform(F.filter(pair, lambda x: ~is_open(x)), lambda x: settled(x, x["p"] >= 1))
            ).alias("done"),
        )
        alone = F.struct(F.array(moved(j, j["p"])).alias("open"), state["done"].alias("done"))
        return F.when(F.size(state["open"]) == 0, alone).otherwise(both)

    return F.aggregate(items, F.struct(no_items.alias("open"), none.alias("done")), step)


def rounded_copies(items: DataFrame) -> DataFrame:
    """Round copy probabilities: ``items`` (source, doc_id, copy, size, p, rows) -> (source, doc_id, copy, size, extra).

    ``size`` is positive, ``p`` lies strictly between 0 and 1, ``rows`` is at least the number of
    the source's items, and (source, doc_id, copy, size) names an item. Each level folds chunks to
    a FAN-th of their rows; the number of levels follows from the largest source.
    """
    most = items.agg(F.max("rows")).first()[0]
    if not most:
        return items.select("source", "doc_id", "copy", "size", F.lit(0).alias("extra")).limit(0)
    open_items, done, left, level = items, [], most, 0
    while True:
        chunks = F.ceil(F.col("rows") / FAN)
        chunked = open_items.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "copy", "size", F.lit(level)), chunks))
        member = F.struct("size", "doc_id", "copy", "p")
        folded = saved(
            chunked.groupBy("source", "chunk", "rows")
            .agg(F.sort_array(F.collect_list(member), asc=False).alias("members"))
            .select("source", "rows", _fold(F.col("members"), level).alias("state"))
            .select("source", "rows", "state.open", "state.done")
        )
        done.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        open_items = folded.select("source", F.ceil(F.col("rows") / FAN).alias("rows"), F.explode("open").alias("o")).select(
            "source", "rows", "o.*"
        )
        if left <= FAN:  # one chunk per source is left, and so at most one open item
            break
        left, level = -(-left // FAN), level + 1
    done.append(open_items.select("source", "doc_id", "copy", "size", F.round("p").cast("int").alias("extra")))
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out.select("source", "doc_id", "copy", "size", "extra")


def mixture(docs: DataFrame) -> DataFrame:
    """Copies of every document in the mix: doc_id, source, size, source_size, target, copies, taken.

    ``docs`` has ``doc_id``, ``source`` and ``text``; other columns are ignored. The size is the
    number of words; null, empty and wordless texts have size 0, get the whole part of the copies
    owed and add no words. A null source is a source of its own, the last. Rows with equal doc_id,
    source and size are counted before any shuffle, then rounded as separate documents; they come
    out as that many rows. Ties in size are ordered by doc_id, then copy. Very long texts
    count with all their words. An empty table gives an empty result.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text").cast("string"))).cast("long").alias("size"),
    )
    kinds = saved(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")))
    goal = saved(targets(kinds))
    owed = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        kinds.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))
        .alias("k")
        .join(goal.alias("g"), F.col("k.source").eqNullSafe(F.col("g.source")))
        .select("k.*", "source_size", "target", "rows", owed.alias("owed"))
        .withColumn("whole", F.floor("owed"))
        .withColumn("p", F.col("owed") - F.col("whole"))
    )
    open_rows = (F.col("p") > 0) & (F.col("size") > 0)
    extras = rounded_copies(rows.where(open_rows).select("source", "doc_id", "copy", "size", "p", "rows"))
    settled = rows.where(~open_rows).select("source", "doc_id", "copy", "size", F.lit(0).alias("extra"))
    every = extras.union(settled).alias("e").join(goal.alias("g"), F.col("e.source").eqNullSafe(F.col("g.source")))
    return every.select(
        "doc_id", "e.source", "size", "source_size", "target", (F.floor(owed) + F.col("extra")).cast("int").alias("copies")
    ).withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with every row repeated by its copies; a row with none goes. Columns stay as they are.

    Rows that share doc_id, source and size get their copies together. If their other columns
    differ, the copies are dealt to the different rows evenly, in the order of a hash of the row.
    """
    per = saved(
        mixture(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("c"), F.count("*").alias("m"))
    )
    # the row travels as one column, so none of its names meets one used here
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text").cast("string"))).cast("long").alias("size"),
    )
    names = ["doc_id", "source", "size"]

    def counted(rows, wanted):
        kept = wanted.where("c > 0").select(*[F.col(n).alias(f"w_{n}") for n in names], "c", "m")
        same = [F.col(n).eqNullSafe(F.col(f"w_{n}")) for n in names]
        return rows.join(kept, same[0] & same[1] & same[2]).select(*rows.columns, "c", "m")

    def repeated(rows, copies):
        times = F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long"))).alias("copy")
        return rows.where(copies > 0).select("row", times).select("row.*")

    out = repeated(counted(keyed, per.where("m = 1")), F.col("c"))
    many = per.where("m > 1")
    if many.isEmpty():
        return out
    kinds = counted(keyed, many).groupBy("row", *names, "c", "m").agg(F.count("*").alias("rows"))
    upto = kinds.selectExpr("*", f"sum(rows) over (partition by {', '.join(names)} order by xxhash64(row)) as upto")
    share = F.floor(F.col("upto") * F.col("c") / F.col("m")) - F.floor((F.col("upto") - F.col("rows")) * F.col("c") / F.col("m"))
    return out.union(repeated(upto, share))
