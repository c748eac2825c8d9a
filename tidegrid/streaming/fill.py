"""The regular table as a stream: gaps are filled when the reading that closes them has arrived."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegrid.functions.timegrid import slot_of, slot_start
from tidegrid.operators.chunked import explode_slots
from tidegrid.operators.regularise import drop_missing, filled_value
from tidegrid.spec import Spec

#: Setting of the state store that keeps values by name.
STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)
STATE = "first bigint, slot bigint, value double"


class _Carry(StatefulProcessor):
    """Each bin of a series next to the one before it; the newest one stays as state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bins = pd.concat(list(rows)).sort_values("slot", ignore_index=True)
        first, slot, value = self.last.get() if self.last.exists() else (int(bins["slot"].iloc[0]), None, None)
        before, was = bins["slot"].shift().astype("Int64"), bins["value"].shift()
        if slot is not None:
            before.iloc[0], was.iloc[0] = slot, value
        self.last.update((first, int(bins["slot"].iloc[-1]), float(bins["value"].iloc[-1])))
        yield pd.DataFrame(
            {"series_id": key[0], "first": first, "before": before, "was": was, "slot": bins["slot"], "value": bins["value"]}
        )

    def close(self) -> None:
        pass


def stream_regular(readings: DataFrame, spec: Spec, delay: str = "1 hour") -> DataFrame:
    """Rows of ``regularise`` as they become final: series_id, ts, value, pos, filled.

    Readings that share a stamp are averaged, then those of a bin, then the bins between two with
    readings are interpolated. A bin is final once it is older than ``delay``, and a gap once the bin
    behind it is; a reading older than that is left out. Bins of a series become final in the order of
    time, so its state is one bin, next to the stamps and bins younger than ``delay``. A series takes
    its new bins of one trigger through one task: bound a backlog by the source's files per trigger.
    Rows without series, stamp or value are left out. The number of rows of a series is never known.
    The state needs the RocksDB store: see ``STORE``, to be set on the session before the stream starts.
    """
    kind = readings.schema["series_id"].dataType.simpleString()
    usable = drop_missing(readings, ["ts", "value"]).where(F.col("series_id").isNotNull())
    stamped = usable.select("series_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("value"))
    stamps = stamped.withWatermark("ts", delay).groupBy("series_id", "ts").agg(F.avg("value").alias("value"))
    bins = stamps.groupBy("series_id", F.window("ts", f"{spec.step} seconds")).agg(F.avg("value").alias("value"))
    slots = bins.select("series_id", slot_of("window.start", spec.step).alias("slot"), "value")
    pairs = slots.groupBy("series_id").transformWithStateInPandas(
        _Carry(), f"series_id {kind}, first bigint, before bigint, was double, slot bigint, value double", "Append", "None"
    )
    begin = F.coalesce(F.col("before") + 1, F.col("slot"))
    ends = pairs.select(
        "series_id", "first", begin.alias("begin"), "slot",
        F.coalesce("was", "value").alias("value_prev"), F.coalesce("before", "slot").alias("value_prev_at"),
        F.col("value").alias("value_next"), F.col("slot").alias("value_next_at"),
    )
    grid = explode_slots(ends, F.col("begin"), F.col("slot"), spec.chunk, "at")
    return grid.select(
        "series_id", slot_start("at", spec.step).alias("ts"),
        F.when(F.col("at") == F.col("slot"), F.col("value_next")).otherwise(filled_value("value", "linear")).alias("value"),
        (F.col("at") - F.col("first")).alias("pos"), (F.col("at") != F.col("slot")).alias("filled"),
    )
