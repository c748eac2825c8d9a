"""As-of join between stamps that lie anywhere: the last value at or before every probe.

Probes and values are sorted together by (series, stamp) and cut into ranges of about equal size,
wherever the rows are: a long series, a busy hour and a single stamp asked a million times all
spread over as many ranges as their rows need. Inside a range the last value is carried forward;
what a range hands on is one row per series and range. Nothing is rounded to a grid and no probe is
joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.session import saved


def asof_merge(
    probes: DataFrame, values: DataFrame, col: str, *, ts: str = "ts", by: str = "series_id", tolerance: float | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``probes`` with ``col``: the last non-missing one of ``values`` at or before the probe, else NULL.

    ``values`` has ``by``, ``ts`` and ``col``; of several values at one stamp the largest counts.
    ``tolerance`` is the greatest age of a value in seconds. Probes keep all their columns (``col``
    itself is replaced) and all their rows, repeats included; without a series or a stamp they find
    nothing. ``ranges`` is the number of ranges, by default that of shuffle partitions.
    """
    spark = probes.sparkSession
    known = values.where(F.col(col).isNotNull() & F.col(by).isNotNull() & F.col(ts).isNotNull())
    known = known.groupBy(by, ts).agg(F.max(col).alias("_value"))
    rest = [c for c in probes.columns if c != col]
    asked = probes.select(
        F.col(by).alias("_by"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"), F.struct(*rest).alias("_row"),
        F.lit(None).cast(known.schema["_value"].dataType).alias("_value"),
    )
    held = known.select(
        F.col(by).alias("_by"), F.col(ts).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"), "_value",
    )
    # equal stamps are split by chance, values first
    both = asked.unionByName(held).withColumn("_deal", F.when(F.col("_kind") == 1, F.rand(7)).otherwise(0.0))
    count = int(spark.conf.get("spark.sql.shuffle.partitions")) if ranges is None else ranges
    order = ["_by", "_at", "_kind", "_deal"]
    # the ranges are written down: what they hand on and what takes it must see the same cut
    dealt = saved(both.repartitionByRange(count, *order).withColumn("_range", F.spark_partition_id()))
    spot = F.when(F.col("_kind") == 0, F.struct("_at", "_value"))
    ends = dealt.groupBy("_by", "_range").agg(F.max(spot).alias("_end"))
    before = W.partitionBy("_by").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select("_by", "_range", F.last("_end", True).over(before).alias("_carried"))
    upto = W.partitionBy("_by", "_range").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = dealt.withColumn("_inside", F.last(spot, True).over(upto)).where("_kind = 1")
    same = F.col("i._by").eqNullSafe(F.col("c._by")) & (F.col("i._range") == F.col("c._range"))
    found = inside.alias("i").join(carried.alias("c"), same, "left")
    hit = F.coalesce("_inside", "_carried")
    usable = F.col("i._by").isNotNull() & F.col("i._at").isNotNull()
    if tolerance is not None:
        age = F.unix_micros(F.col("i._at").cast("timestamp")) - F.unix_micros(hit["_at"].cast("timestamp"))
        usable = usable & (age <= int(tolerance * 1_000_000))
    return found.select("i._row.*", F.when(usable, hit["_value"]).alias(col))
