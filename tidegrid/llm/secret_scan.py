"""Secrets in documents through a trigram index.

Each rule is a regular expression. From it follows a Boolean query over trigrams: alternatives, of
which one must have all its trigrams in the text. Documents post the trigrams they hold; a rule's
candidates are the documents whose postings meet all trigrams of an alternative. Only candidates
are searched with the expression. A rule without mandatory trigrams is run over every text.

Everything runs as DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as tokens  # the parse tree of the standard library's expressions
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTH = 3
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches greedily, leftmost first; then ``least`` characters of ``group`` must be there."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    base: bool = False


def either_case(text: str) -> str:
    """``text`` with a class of both cases for every letter, so that no other letter folds in."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else c for c in text)


_NAME = "|".join(either_case(n) for n in ("password", "passwd", "secret", "token", "api_?key"))
RULES: tuple[Rule, ...] = (
    Rule("assign", f"({_NAME})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2, True),
    Rule("access", "AKIA[A-Z0-9]+", 20, 0, True),
    Rule("hex", "[0-9a-f]+", 24, 0, True),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
)


def _states(tree) -> list[tuple[str | None, frozenset, str]]:
    """Alternatives of a part: (text before its first cut or None if uncut, inner runs, text after its last cut)."""
    items = list(tree)
    out: list[tuple[str | None, frozenset, str]] = [(None, frozenset(), "")]
    for op, arg in items:
        char = None
        if op is tokens.LITERAL:
            char = chr(arg).lower()
        elif op is tokens.IN and all(o is tokens.LITERAL for o, _ in arg) and len({chr(a).lower() for _, a in arg}) == 1:
            char = chr(arg[0][1]).lower()
        if char is not None:
            out = [(h, m, t + char) for h, m, t in out]
            continue
        if op is tokens.SUBPATTERN or op is tokens.BRANCH or (op is tokens.MAX_REPEAT and arg[:2] == (0, 1)):
            choices = [arg[-1]] if op is tokens.SUBPATTERN else list(arg[1]) if op is tokens.BRANCH else [arg[2], []]
            grown = []
            for h, m, t in out:
                for choice in choices:
                    for h2, m2, t2 in _states(choice):
                        if h2 is None:
                            grown.append((h, m | m2, t + t2))
                        elif h is None:
                            grown.append((t + h2, m | m2, t2))
                        else:
                            grown.append((h, m | m2 | ({t + h2} if t + h2 else frozenset()), t2))
            out = list(dict.fromkeys(grown))
            continue
        out = [(t, m, "") if h is None else (h, m | ({t} if t else frozenset()), "") for h, m, t in out]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams, in lower case, one of which every match of ``pattern`` holds.

    None when some match needs no trigram: such a rule has to look at every text.
    """
    states = _states(parser.parse(pattern))
    if len(states) > MOST_ALTERNATIVES:
        return None
    query = set()
    for head, runs, tail in states:
        parts = set(runs) | {tail} | ({head} if head else set())
        grams = frozenset(p[i : i + LENGTH] for p in parts for i in range(len(p) - LENGTH + 1))
        if not grams:
            return None
        query.add(grams)
    return sorted((q for q in query if not any(o < q for o in query)), key=sorted)


def spans(text: Column, rule: Rule) -> Column:
    """Matches of a rule in order: array of (start, end), code points, end exclusive."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    found = F.arrays_zip(whole.alias("whole"), held.alias("held"), F.slice(between, 1, F.size(whole)).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(state, m):
        begin = state["at"] + F.length(m["gap"])
        end = begin + F.length(m["whole"])
        hit = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(F.length(m["held"]) >= rule.least, F.concat(state["out"], hit)).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(found, start, step, lambda s: s["out"])


def postings(texts: DataFrame, grams: Sequence[str]) -> DataFrame:
    """The index: one row (gram, key) for every queried trigram that a text holds in any case.

    Lower case of all of Unicode can only add postings here; the expressions decide.
    """
    held = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col("folded"), g))
    return texts.select("key", "doc_id", F.lower("text").alias("folded")).select(
        "key", "doc_id", F.explode(held).alias("gram")
    )


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per text the rules with an alternative whose postings all meet there: (doc_id, key, rules)."""
    clauses = [(r.kind, k, g) for r in rules for k, alt in enumerate(trigram_query(r.pattern) or []) for g in sorted(alt)]
    by_gram: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for kind, k, gram in clauses:
        by_gram.setdefault(gram, []).append(f"{kind}:{k}")
        size[f"{kind}:{k}"] = size.get(f"{kind}:{k}", 0) + 1
    lookup = F.create_map(*[x for g, c in by_gram.items() for x in (F.lit(g), F.array(*map(F.lit, c)))])
    need = F.create_map(*[x for c, n in size.items() for x in (F.lit(c), F.lit(n))])
    met = (
        index.select("doc_id", "key", "gram", F.explode(lookup[F.col("gram")]).alias("clause"))
        .groupBy("doc_id", "key", "clause")
        .agg(F.size(F.collect_set("gram")).alias("met"))
    )
    return (
        met.where(F.col("met") == need[F.col("clause")])
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.split_part("clause", F.lit(":"), F.lit(1))).alias("rules"))
    )


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Spans of each rule in each document: doc_id, text's spans as array of (start, end, kind, rank, base).

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null text counts as empty
    and has no spans. Repeated rows stay repeated; equal starts are ordered by the rules' order. A
    row without doc_id is searched like any other. An empty table gives an empty result. A text of
    any length is searched whole. Only trigrams are grouped, reduced before their shuffle; texts are
    shuffled once, by the join, whose partitions adaptive execution splits where rows repeat.
    """
    indexed = [r for r in rules if trigram_query(r.pattern) is not None]
    grams = sorted({g for r in indexed for alt in trigram_query(r.pattern) for g in alt})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # the key leads a row back to its rules; texts that share one only get each other's rules verified too
    keyed = keyed.withColumn("key", F.xxhash64("doc_id", "text"))
    hits = candidates(postings(keyed, grams), indexed).select(F.col("doc_id").alias("id"), F.col("key").alias("at"), "rules")
    rows = keyed.join(hits, keyed["doc_id"].eqNullSafe(hits["id"]) & (keyed["key"] == hits["at"]), "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:string,rank:int,base:boolean>>")
    found = []
    for rank, rule in enumerate(rules):
        asked = F.array_contains("rules", rule.kind) if rule in indexed else F.lit(True)
        found.append(F.when(asked, _labelled(spans(F.col("text"), rule), rule, rank)).otherwise(none))
    return rows.select("doc_id", "text", F.array_sort(F.concat(*found), _by_start).alias("spans"))


def _labelled(found: Column, rule: Rule, rank: int) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rank).alias("rank"),
            F.lit(rule.base).alias("base"),
        ),
    )


def _by_start(a, b):
    left, right = (F.struct(x["start"], x["rank"]) for x in (a, b))
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text."""

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def oracle_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same spans by running every expression over every text, without an index."""
    arms = []
    for rank, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        arms.append(f"""
SELECT doc, {rank} AS rank, '{rule.kind}' AS kind, {str(rule.base).lower()} AS base, len(held) >= {rule.least} AS good,
  sum(len(gap) + len(whole)) OVER (PARTITION BY doc ORDER BY k) AS stop, len(whole) AS width
FROM (SELECT doc, unnest(range(len(w))) AS k, unnest(w) AS whole, unnest(h) AS held, unnest(g[1:len(w)]) AS gap
  FROM (SELECT doc, regexp_extract_all(t, '{pattern}', 0) AS w, regexp_extract_all(t, '{pattern}', {rule.group}) AS h,
        string_split_regex(t, '{pattern}') AS g FROM d))""")
    text = "kind || ':' || (stop - width)::BIGINT || ':' || stop::BIGINT"
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({' UNION ALL '.join(arms)}),
per AS (SELECT doc, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ('assign', 'access', 'hex'))},
  string_agg({text}, ',' ORDER BY stop - width, rank) FILTER (base) AS base,
  string_agg({text}, ',' ORDER BY stop - width, rank) AS spans FROM hits WHERE good GROUP BY doc)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (doc)"""
