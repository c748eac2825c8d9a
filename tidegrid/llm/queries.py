"""Registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import (
    decontaminate, extract, minhash, mixing, near_vectors, personal_data, quality, ranked_search, runs, secret_scan,
    sharding, token_counts, toxicity,
)
from tidegrid.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assignments(table(spark, sf_dir, "documents"))


@query
def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extracted(table(spark, sf_dir, "pages"))


@query
def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(runs.with_planted_run(table(spark, sf_dir, "documents"))))


@query
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find_personal_data(table(spark, sf_dir, "documents")))


#: Queries that SQL cannot express; tests compare them with plain versions.
WITHOUT_SQL = ("op2_toxicity", "op3_token_counts", "op5_extract", "op7_mixing", "op8_quality", "op9_decontamination", "op11_runs")


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_vectors": near_vectors.oracle_sql(),
        "op4_sharding": sharding.oracle_sql(),
        "op6_minhash_dedup": minhash.oracle_sql(),
        "op10_secrets": secret_scan.oracle_sql(),
        "op12_search": ranked_search.oracle_sql(),
        "op13_personal_data": personal_data.oracle_sql(),
    }
