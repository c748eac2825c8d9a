"""Which grid slots have no reading, and how they cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import on_grid, slot_of, slot_start
from tidegrid.operators.chunked import explode_slots, with_neighbours
from tidegrid.operators.regularise import drop_missing
from tidegrid.spec import Spec


def _blocks(raw: DataFrame, spec: Spec, mode: str) -> DataFrame:
    """Runs of missing slots as ``series_id, lo, hi`` in slot numbers.

    ``exact``: only a stamp that is exactly on the grid covers its slot, and the grid
    runs from the floor of the first to the ceiling of the last stamp. ``bin``: any
    reading inside a bin covers it, and the grid ends with the last bin.

    Runs are read off the distance from one covered slot to the next, in one pass over
    the slots that have readings. The grid itself is never built.
    """
    if mode not in ("exact", "bin"):
        raise ValueError(f"unknown gap mode: {mode}")
    exact = mode == "exact"
    slot = slot_of("ts", spec.step)
    whole = on_grid("ts", spec.step)
    seen = (
        drop_missing(raw, ["ts", "value"])
        .groupBy("series_id", slot.alias("slot"))
        .agg(F.max(whole).alias("whole"), F.min(whole).alias("only_whole"))
        .select(
            "series_id",
            "slot",
            (F.when(F.col("whole"), F.col("slot")) if exact else F.col("slot")).alias("covered"),
            # A reading inside the last slot moves the end of the grid to the slot after it.
            (F.when(~F.col("only_whole"), F.lit(1)) if exact else F.lit(None).cast("int")).alias("inside"),
        )
    )
    near = with_neighbours(seen, ["covered", "inside"], at="slot", span=spec.chunk, extent=True)
    beyond = F.coalesce(F.col("inside_last_at") == F.col("last_at"), F.lit(False)).cast("bigint")
    end = F.col("last_at") + beyond
    # The first row answers for the slots before the first covered one, each covered row
    # for those behind it.
    leading = F.struct(F.col("slot").alias("lo"), F.coalesce(F.col("covered_first_at") - 1, end).alias("hi"))
    behind = F.struct((F.col("slot") + 1).alias("lo"), F.coalesce(F.col("covered_next_at") - 1, end).alias("hi"))
    runs = F.array(
        F.when(F.col("slot") == F.col("first_at"), leading), F.when(F.col("covered").isNotNull(), behind)
    )
    return near.select("series_id", F.explode(runs).alias("run")).select("series_id", "run.lo", "run.hi").where("lo <= hi")


def missing_blocks(raw: DataFrame, spec: Spec, mode: str = "exact") -> DataFrame:
    """Start, end and length of every run of missing slots."""
    return _blocks(raw, spec, mode).select(
        "series_id",
        slot_start("lo", spec.step).alias("start"),
        slot_start("hi", spec.step).alias("end"),
        (F.col("hi") - F.col("lo") + 1).alias("slots"),
    )


def missing_slots(raw: DataFrame, spec: Spec, mode: str = "exact") -> DataFrame:
    """Every grid stamp without a reading."""
    blocks = _blocks(raw, spec, mode)
    slots = explode_slots(blocks, F.col("lo"), F.col("hi"), spec.chunk, "slot")
    return slots.select("series_id", slot_start("slot", spec.step).alias("ts"))


def top_missing_blocks(raw: DataFrame, spec: Spec, mode: str = "exact", top: int = 5) -> DataFrame:
    """The longest runs per series; equal lengths in time order.

    Spark keeps the first ``top`` rows per series on the map side, so a series with
    very many runs still sends only a few rows to its task.
    """
    longest = W.partitionBy("series_id").orderBy(F.desc("slots"), "start")
    ranked = missing_blocks(raw, spec, mode).withColumn("rank", F.row_number().over(longest))
    return ranked.where(F.col("rank") <= top)
