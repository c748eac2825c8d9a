"""Personal data in documents: checked expressions, and identifiers learned from their context.

Expressions with checks find the base: e-mail and network addresses, card and phone numbers. They
are the seeds of a bootstrap. A *slot* is a stretch of words that each hold a digit or an @; its
*instance* is the text without punctuation around it. The words next to a slot are its lexical
patterns: two words before it, one before it, one on either side. Patterns and instances form a
graph, scored in rounds:

* a pattern's confidence for a kind is the share of that kind, by the instances' scores, in all
  different instances the pattern stands with;
* an instance's score is one for a seed, else what its accepted patterns say together, by noisy or.

A pattern is accepted with a confidence of CONFIDENT and the score of SUPPORT instances. Slots in an
accepted pattern, whose instance has the shape of the kind and reaches CONFIDENT, are identifiers
that no expression saw. Scores are whole thousandths and evidence whole millionths, so sums do not
depend on their order.

Everything runs as DataFrame functions. Texts are read once and never shuffled: what leaves the scan
is a table of spans and slots. Confidence counts different pairs of pattern and instance, so
repeated texts add nothing, and a pattern or instance that most documents share is pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import lower_ascii, saved, written

#: Rounds of scoring; thousandths that accept a pattern and an instance; instances behind a pattern.
ROUNDS, CONFIDENT, SUPPORT = 3, 700, 3
#: Characters before and after a slot in which its neighbour words are looked for.
BEFORE, AFTER = 64, 32
#: Longer instances are known by their digest only.
INSTANCE_CHARS = 64
#: Matches that are put in place together; see ``_located``.
RUN = 500


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds the base leftmost first, without going back; ``plain`` is the same to read.

    ``sign`` is a character that every match holds, if there is one. ``shape`` is what an
    identifier of this kind looks like when its context gives it away, with a number of digits.
    """

    name: str
    pattern: str
    plain: str
    sign: str
    shape: str
    digits: tuple[int, int]


#: In order of the result. A match of the local part, or of digits, starts where none can start
#: earlier, or where the last match ended; nothing is read twice, so time is linear in the text.
KINDS: tuple[Kind, ...] = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "@", r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+$", (0, 64),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        ".", r"^[0-9]+([.:][0-9]+){3,5}$", (4, 24),
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        r"[0-9]([\x20-]?[0-9])+",
        "", r"^[0-9]([\x20-]?[0-9])+$", (12, 19),
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+", r"^[+(]?[0-9][\x20().0-9-]+[0-9]$", (7, 15),
    ),
)
NAMES = tuple(k.name for k in KINDS)

#: A word, a slot without going back, and the same slot to read.
WORD = r"[^\x20\x09-\x0D]+"
SLOT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)*+"
SLOT_PLAIN = r"[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*(\x20[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*)*"
CORE = r"[A-Za-z0-9+(]([^\n]*[A-Za-z0-9])?"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _located(text: Column, pattern: str, kind: str, make: Callable, good: Callable) -> Column:
    """Matches as an array of ``kind``: ``make(match, start, end)`` where ``good(match's text)``.

    A match has ``whole``, and ``before`` and ``after``, the text up to its neighbours. Starts are
    running sums; they are built RUN matches at a time, so that a text with very many matches does
    not copy its list for each.
    """
    none = F.array().cast(f"array<{kind}>")

    def placed(whole: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        n = F.size(whole)
        zipped = _bound(
            gaps,
            lambda g: F.arrays_zip(whole.alias("whole"), F.slice(g, F.lit(1), n).alias("before"), F.slice(g, F.lit(2), n).alias("after")),
        )
        runs = _bound(
            zipped,
            lambda z: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / RUN)), lambda k: F.slice(z, (k * RUN + 1).cast("int"), F.lit(RUN))),
        )

        def step(state: Column, m: Column) -> Column:
            begin = state["at"] + F.length(m["before"])
            end = begin + F.length(m["whole"])
            out = F.when(good(m["whole"]), F.concat(state["out"], F.array(make(m, begin, end).cast(kind)))).otherwise(state["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        def outer(state: Column, run: Column) -> Column:
            inner = F.aggregate(run, F.struct(state["at"].alias("at"), none.alias("out")), step)
            return _bound(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(state["out"], F.array(r["out"])).alias("out")))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.flatten(F.aggregate(runs, start, outer)["out"])

    return _bound(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda w: F.when(F.size(w) > 0, placed(w)).otherwise(none)
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _good(name: str) -> Callable[[Column], Column]:
    """The check of a base match of the kind."""
    if name == "ip":
        def part(p: Column) -> Column:
            short = F.regexp_replace(p, "^0+", "")
            return F.when(F.length(short) > 3, False).otherwise(F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)

        return lambda m: F.forall(F.split(m, r"\."), part)
    if name == "card":
        return lambda m: _bound(_digits(m), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    if name == "phone":
        return lambda m: F.length(_digits(m)).between(9, 15)
    return lambda m: F.lit(True)


def base_spans(text: Column, kind: Kind) -> Column:
    """Checked matches of a kind: array of (start, end), code points, end exclusive."""
    span = "struct<start:int,end:int>"
    found = _located(text, kind.pattern, span, lambda m, a, b: F.struct(a.alias("start"), b.alias("end")), _good(kind.name))
    if not kind.sign:
        return found
    return F.when(F.contains(text, F.lit(kind.sign)), found).otherwise(F.array().cast(f"array<{span}>"))


def _slots(text: Column) -> Column:
    """Slots of a text: where the instance lies, the instance, and the words around it."""
    kind = "struct<start:int,end:int,core:string,l2:string,l1:string,r1:string>"

    def make(m: Column, begin: Column, end: Column) -> Column:
        left = F.regexp_extract_all(lower_ascii(F.substring(m["before"], -BEFORE, BEFORE)), F.lit(WORD), F.lit(0))
        right = F.regexp_extract(lower_ascii(F.substring(m["after"], 1, AFTER)), WORD, 0)

        def built(core: Column) -> Column:
            at = begin + F.instr(m["whole"], core) - 1
            return _bound(
                left,
                lambda w: F.struct(
                    at.alias("start"),
                    (at + F.length(core)).alias("end"),
                    F.when(F.length(core) <= INSTANCE_CHARS, core).otherwise(F.md5(core)).alias("core"),
                    F.coalesce(F.get(w, F.size(w) - 2), F.lit("")).alias("l2"),
                    F.coalesce(F.get(w, F.size(w) - 1), F.lit("")).alias("l1"),
                    right.alias("r1"),
                ),
            )

        return _bound(F.regexp_extract(m["whole"], CORE, 0), built)

    return _located(text, SLOT, kind, make, lambda w: w.rlike("[A-Za-z0-9]"))


def analysed(docs: DataFrame) -> DataFrame:
    """One pass over the texts: row (a key of its own), doc_id, the base spans of each kind, and the slots."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return written(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            *[base_spans(F.col("text"), k).alias(k.name) for k in KINDS],
            _slots(F.col("text")).alias("slots"),
        )
    )


def mentions(table: DataFrame) -> DataFrame:
    """Slots with their patterns: row, start, end, core, pattern, the kinds it may be of and those it is a seed of.

    A slot that a base span overlaps without being it can be of no kind, but counts against its patterns.
    """
    slots = table.select("row", *NAMES, F.explode("slots").alias("s")).select("row", *NAMES, "s.*")
    seeds = [F.when(F.exists(k, lambda b: (b["start"] == F.col("start")) & (b["end"] == F.col("end"))), F.lit(k)) for k in NAMES]
    touched = F.lit(False)
    for k in NAMES:
        touched = touched | F.exists(k, lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))
    digits = F.length(_digits(F.col("core")))
    shapes = [
        F.when((F.length("core") <= INSTANCE_CHARS) & digits.between(*k.digits) & F.col("core").rlike(k.shape), F.lit(k.name))
        for k in KINDS
    ]
    patterns = F.array(
        F.concat_ws(" ", F.lit("2"), "l2", "l1"),
        F.concat_ws(" ", F.lit("1"), "l1"),
        F.concat_ws(" ", F.lit("b"), "l1", "r1"),
    )
    known = F.array_compact(F.array(*seeds))
    free = F.when(touched, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*shapes)))
    marked = slots.select("row", "start", "end", "core", known.alias("seeds"), F.array_union(known, free).alias("kinds"), patterns.alias("p"))
    return marked.select("row", "start", "end", "core", "seeds", "kinds", F.explode("p").alias("pattern"))


def pattern_graph(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (pattern, core, kind, seed) between patterns and what they may extract, and the size of every pattern."""
    pairs = found.groupBy("pattern", "core").agg(
        F.array_distinct(F.flatten(F.collect_set("kinds"))).alias("kinds"),
        F.array_distinct(F.flatten(F.collect_set("seeds"))).alias("seeds"),
    )
    pairs = saved(pairs)
    sizes = pairs.groupBy("pattern").agg(
        F.count("*").alias("total"), F.max(F.when(F.size("kinds") > 0, 1).otherwise(0)).alias("able")
    )
    edges = pairs.select("pattern", "core", "seeds", F.explode("kinds").alias("kind")).select(
        "pattern", "core", "kind", F.array_contains("seeds", F.col("kind")).cast("int").alias("seed")
    )
    return edges, sizes.where("able = 1").select("pattern", "total")


def bootstrapped(edges: DataFrame, sizes: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, kind, confidence) and all scored instances (core, kind, score)."""
    edges = saved(edges.join(sizes, "pattern"))
    scores = edges.groupBy("core", "kind").agg((F.max("seed") * 1000).alias("score")).where("score > 0")
    accepted = None
    for _ in range(rounds):
        held = edges.join(scores, ["core", "kind"]).groupBy("pattern", "kind", "total").agg(F.sum("score").alias("held"))
        confidence = F.expr("held div total")
        accepted = saved(
            held.select("pattern", "kind", F.least(confidence, F.lit(990)).alias("confidence")).where(
                (F.col("confidence") >= CONFIDENT) & (F.col("held") >= 1000 * SUPPORT)
            )
        )
        evidence = F.floor(-1_000_000 * F.log(1 - F.col("confidence") / 1000))
        said = edges.join(accepted, ["pattern", "kind"]).groupBy("core", "kind").agg(F.sum(evidence).alias("evidence"))
        told = said.select("core", "kind", F.floor(1000 * (1 - F.exp(-F.col("evidence") / 1_000_000))).alias("score"))
        seeds = edges.groupBy("core", "kind").agg((F.max("seed") * 1000).alias("score")).where("score > 0")
        scores = saved(seeds.unionByName(told).groupBy("core", "kind").agg(F.max("score").alias("score")))
    return accepted, scores


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Identifiers of every document: doc_id and spans, an array of (start, end, kind, rank, base).

    ``base`` marks what the checked expressions found; the others were learned from their context.
    Spans are ordered by the kinds' order, then start; positions are code points, ends exclusive.
    Null texts count as empty and have no spans; very long texts are read whole, in linear time.
    Repeated rows stay repeated and teach nothing twice; rows without doc_id are searched like any
    other; other columns are ignored. An empty table gives an empty result. Learning depends on the
    whole table: another table may accept other patterns, but base spans are always the same.
    """
    table = analysed(docs)
    found = mentions(table)
    accepted, scores = bootstrapped(*pattern_graph(found))
    learned = (
        found.select("row", "start", "end", "core", "pattern", "seeds", F.explode("kinds").alias("kind"))
        .where(~F.array_contains("seeds", F.col("kind")))
        .join(accepted.select("pattern", "kind"), ["pattern", "kind"], "left_semi")
        .join(scores.where(F.col("score") >= CONFIDENT).select("core", "kind"), ["core", "kind"], "left_semi")
        .select("row", "start", "end", "kind")
        .distinct()
    )
    rank = F.array_position(F.array(*[F.lit(n) for n in NAMES]), F.col("kind")).cast("int") - 1
    extra = learned.groupBy("row").agg(
        F.collect_list(F.struct("start", "end", "kind", rank.alias("rank"), F.lit(False).alias("base"))).alias("extra")
    )
    def labelled(kind: str, rank: int) -> Column:
        names = {"start": None, "end": None, "kind": F.lit(kind), "rank": F.lit(rank), "base": F.lit(True)}
        return F.transform(kind, lambda s: F.struct(*[(s[n] if v is None else v).alias(n) for n, v in names.items()]))

    base = [labelled(k, r) for r, k in enumerate(NAMES)]
    all_ = F.concat(*base, F.coalesce("extra", F.array().cast("array<struct<start:int,end:int,kind:string,rank:int,base:boolean>>")))
    return table.join(extra, "row", "left").select("doc_id", F.array_sort(all_, _in_order).alias("spans"))


def _in_order(a: Column, b: Column) -> Column:
    left, right = (F.struct(x["rank"], x["start"], x["end"]) for x in (a, b))
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def digest(found: DataFrame) -> DataFrame:
    """Counts and the hash of the base spans, and all spans as text."""

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in NAMES],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def oracle_sql() -> str:
    """The same spans with the plain expressions, and the rounds of scoring written out."""
    fold = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    digits = "regexp_replace({}, '[^0-9]', '', 'g')"
    d = digits.format("whole")
    luhn = (
        f"list_sum([CASE WHEN i % 2 = 1 THEN x WHEN x > 4 THEN 2 * x - 9 ELSE 2 * x END "
        f"FOR x, i IN [c::INTEGER FOR c IN string_split(reverse({d}), '')]]) % 10 = 0"
    )
    short = "regexp_replace(p, '^0+', '')"
    parts = f"[len({short}) <= 3 AND coalesce(try_cast({short} AS INTEGER), 0) <= 255 FOR p IN string_split(whole, '.')]"
    good = {
        "email": "true",
        "ip": f"list_bool_and({parts})",
        "card": f"CASE WHEN len({d}) BETWEEN 13 AND 19 THEN {luhn} ELSE false END",
        "phone": f"len({d}) BETWEEN 9 AND 15",
    }

    def matches(pattern: str) -> str:
        return f"""(SELECT doc, k, whole, before, after, sum(len(before) + len(whole)) OVER (PARTITION BY doc ORDER BY k) AS stop
  FROM (SELECT doc, unnest(range(len(w))) AS k, unnest(w) AS whole, unnest(g[1:len(w)]) AS before, unnest(g[2:]) AS after
    FROM (SELECT doc, regexp_extract_all(t, '{pattern}', 0) AS w, string_split_regex(t, '{pattern}') AS g FROM d) WHERE len(w) > 0))"""

    base = " UNION ALL ".join(
        f"SELECT doc, '{k.name}' AS kind, {r} AS rank, (stop - len(whole))::BIGINT AS a, stop::BIGINT AS b FROM {matches(k.plain)} WHERE {good[k.name]}"
        for r, k in enumerate(KINDS)
    )
    shapes = ", ".join(
        f"CASE WHEN len(core) <= {INSTANCE_CHARS} AND n BETWEEN {k.digits[0]} AND {k.digits[1]} AND regexp_matches(core, '{k.shape}') THEN '{k.name}' END"
        for k in KINDS
    )
    rounds, scores = [], "s0"
    for r in range(1, ROUNDS + 1):
        rounds.append(f"""
a{r} AS (SELECT pattern, kind, least(held // total, 990) AS conf FROM
  (SELECT pattern, kind, total, sum(score)::BIGINT AS held FROM e JOIN {scores} USING (core, kind) GROUP BY ALL)
  WHERE held // total >= {CONFIDENT} AND held >= {1000 * SUPPORT}),
s{r} AS (SELECT core, kind, max(score) AS score FROM (SELECT core, kind, score FROM s0 UNION ALL
  SELECT core, kind, floor(1000 * (1 - exp(-sum(floor(-1000000 * ln(1 - conf / 1000)))::DOUBLE / 1000000)))::BIGINT
  FROM e JOIN a{r} USING (pattern, kind) GROUP BY core, kind) GROUP BY ALL)""")
        scores = f"s{r}"
    text = "kind || ':' || a || ':' || b"
    counts = ", ".join(f"count(*) FILTER (base AND kind = '{k}') AS n_{k}" for k in NAMES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS t FROM documents),
b AS ({base}),
cut AS (SELECT doc, k, (stop - len(whole))::BIGINT AS lo, whole, regexp_extract(whole, '{CORE}', 0) AS inst,
  regexp_extract_all({fold.format(f'right(before, {BEFORE})')}, '{WORD}') AS w,
  regexp_extract({fold.format(f'left(after, {AFTER})')}, '{WORD}') AS r1 FROM {matches(SLOT_PLAIN)} WHERE regexp_matches(whole, '[A-Za-z0-9]')),
slot AS (SELECT doc, k, lo + instr(whole, inst) - 1 AS a, lo + instr(whole, inst) - 1 + len(inst) AS b,
  CASE WHEN len(inst) <= {INSTANCE_CHARS} THEN inst ELSE md5(inst) END AS core,
  coalesce(w[-2], '') AS l2, coalesce(w[-1], '') AS l1, r1 FROM cut),
touch AS (SELECT s.doc, s.k, list(DISTINCT kind) FILTER (s.a = b.a AND s.b = b.b) AS seeds FROM slot s JOIN b ON s.doc = b.doc AND b.a < s.b AND b.b > s.a GROUP BY ALL),
m AS (SELECT doc, a, b, core, unnest(['2 ' || l2 || ' ' || l1, '1 ' || l1, 'b ' || l1 || ' ' || r1]) AS pattern, coalesce(seeds, []) AS seeds,
  CASE WHEN t.doc IS NULL THEN [x FOR x IN [{shapes}] IF x IS NOT NULL] ELSE coalesce(seeds, []) END AS kinds
  FROM (SELECT *, len({digits.format('core')}) AS n FROM slot) s LEFT JOIN (SELECT doc AS doc, k, seeds FROM touch) t USING (doc, k)),
size AS (SELECT pattern, count(DISTINCT core) AS total FROM m GROUP BY pattern),
e AS (SELECT pattern, core, kind, total, max(list_contains(seeds, kind)::INTEGER) AS seed FROM
  (SELECT pattern, core, unnest(kinds) AS kind, seeds FROM m) JOIN size USING (pattern) GROUP BY ALL),
s0 AS (SELECT core, kind, 1000::BIGINT AS score FROM e WHERE seed = 1 GROUP BY ALL),{','.join(rounds)},
x AS (SELECT DISTINCT doc, a, b, kind FROM (SELECT doc, a, b, core, pattern, seeds, unnest(kinds) AS kind FROM m)
  JOIN a{ROUNDS} USING (pattern, kind) JOIN {scores} USING (core, kind) WHERE score >= {CONFIDENT} AND NOT list_contains(seeds, kind)),
y AS (SELECT doc, kind, rank, a, b, true AS base FROM b UNION ALL
  SELECT doc, kind, list_position({list(NAMES)}, kind) - 1, a, b, false FROM x),
per AS (SELECT doc, {counts}, string_agg({text}, ',' ORDER BY rank, a, b) FILTER (base) AS base, string_agg({text}, ',' ORDER BY rank, a, b) AS spans FROM y GROUP BY doc)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in NAMES)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (doc)"""
