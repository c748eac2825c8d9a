"""Helpers of the training-data operators: tables, restart points, linked groups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words in every operator here: space and the five ASCII controls from tab on.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a batch that are tested together.
ROWS_AT_ONCE = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidegrid-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a copy in the checkpoint folder."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a Parquet table in the checkpoint folder: smaller, for whole texts."""
    path = f"{_checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def where_text(docs: DataFrame, test: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Rows whose ``text`` passes ``test``, a function of a string array; the columns stay as they are.

    Rows stay in Arrow batches and are tested some at a time, so no copy of a whole batch is made.
    """
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                keep = test(part.column(place).cast(pa.string()))
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def words(text):
    """Words of a text column, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def lower_ascii(text):
    return F.translate(text, UPPER, LOWER)


def row_bytes(text):
    """UTF-8 bytes of a text; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that each node of ``edges`` (a, b) reaches, as (node, component).

    Alternates two rewirings until no edge changes: every node hands its larger, then its
    smaller neighbours to the smallest node of its neighbourhood. The edges of a component
    become a star around its smallest node in a logarithmic number of rounds, and their number
    never grows. Only nodes with a link to another node are returned.
    """
    stars = saved(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours go to the smallest of the neighbourhood
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # smaller neighbours, and the node itself, go to the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u != v")
            .distinct()
        )
        stars = saved(small)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
