"""The pipeline against plain versions of its stages, and the registered queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.cases import awkward, groups, shingles, words
from tests.llm.test_native import plain_place
from tests.llm.test_texts import plain_matches
from tidegrid.llm import mixing, quality, queries, sharding
from tools.check import compare, database

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]

    good = stage["quality"](spark, docs, sf_dir)
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    wanted = {r.doc_id for r in quality.scored(docs, trees).collect() if r.predicted}
    assert rows(good) == rows(docs.where(F.col("doc_id").isin(wanted)))
    good = spark.createDataFrame(good.collect(), docs.schema)

    unique = stage["near_duplicates"](spark, good, sf_dir)
    sets = [(r.doc_id, frozenset(shingles(r.text))) for r in good.collect()]
    links = [
        (a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 4 * len(x & y) >= 3 * len(x | y)
    ]
    low = groups(links, [i for i, _ in sets])
    assert rows(unique) == rows(good.where(F.col("doc_id").isin({i for i in low if low[i] == i})))
    unique = spark.createDataFrame(unique.collect(), docs.schema)

    clean = stage["decontamination"](spark, unique, sf_dir)
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    grams = {s for _, t in items for s in shingles(t)}
    found = {
        r.doc_id for r in unique.collect() if not grams.isdisjoint(shingles(r.text)) and plain_matches(r.text, items)
    }
    assert found and rows(clean) == rows(unique.where(~F.col("doc_id").isin(found)))
    clean = spark.createDataFrame(clean.collect(), docs.schema)

    mix = stage["mixing"](spark, clean, sf_dir)
    copies = {r.doc_id: r.copies for r in mixing.mixture(clean).collect()}
    assert rows(mix) == sorted((tuple(r) for r in clean.select(COLUMNS).collect() for _ in range(copies[r.doc_id])), key=str)

    placed = stage["sharding"](spark, mix, sf_dir)
    assert rows(placed) == rows(mix)
    assert all(r.shard == plain_place(r.doc_id, sharding.cluster()) for r in placed.select("doc_id", "shard").collect())

    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, placed.collect()), key=str)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, sf_dir, name, stage):
    docs = awkward(spark, ["some words of a fine text that stands alone"] * 2)
    got = stage(spark, docs, sf_dir)
    if name != "sharding":
        assert got.columns == docs.columns
    assert 0 < got.count() <= 3 * docs.count()
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_every_query_is_registered():
    names = set(queries.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 11)} and len(names) == 10
    assert names == set(queries.oracle_sql()) | set(queries.WITHOUT_SQL)
    assert names | {"pipeline"} <= set(entry.queries())
    assert words("A b") == ["a", "b"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    assert compare(spark, database(sf_dir), sf_dir, name, queries.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", queries.WITHOUT_SQL)
def test_query_without_sql_covers_its_table(spark, sf_dir, name):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    n = queries.QUERIES[name](spark, sf_dir).count()
    table = "pages" if "extract" in name else "documents"
    assert n > 0 if "decontamination" in name else n == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
