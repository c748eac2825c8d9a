"""Result tables, reports and their writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.parsing import safe_name
from tidegrid.operators.evaluate import METRIC_LABELS

#: Folders of the hashed layout.
BUCKETS = 256


def forecast_table(
    history: DataFrame,
    forecasts: DataFrame,
    models: Sequence[str],
    weather: DataFrame | None = None,
    measures: Sequence[str] = (),
) -> DataFrame:
    """History, every model and the weather on one time axis per series.

    The parts are stacked and pivoted with one shuffle instead of full outer joins. Each
    stamp occurs once per part.
    """
    stacked = history.select("series_id", "ts", F.col("value").alias("demand_history"))
    named = [F.when(F.col("model") == m, F.col("yhat")).alias(f"{m}_forecast") for m in models]
    stacked = stacked.unionByName(
        forecasts.where(F.col("model").isin(*models)).select("series_id", "ts", *named), allowMissingColumns=True
    )
    if weather is not None:
        renamed = weather.select("series_id", "ts", *[F.col(m).alias(f"weather_{m}") for m in measures])
        stacked = stacked.unionByName(renamed, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in ("series_id", "ts")]
    table = stacked.groupBy("series_id", "ts").agg(*[F.max(c).alias(c) for c in values])
    return table.select("series_id", F.col("ts").alias("timestamp"), *values)


def _folder(layout: str, stamp: Column | None = None) -> Column:
    """Folder of a row: ``bucket`` is a hash of the series, ``series`` its safe name, ``date`` the month."""
    name = F.col("series_id").cast("string")
    if layout == "series":
        return safe_name(name)
    if layout == "date" and stamp is not None:
        return F.date_format(stamp, "yyyy-MM")
    if layout == "bucket":
        return F.format_string("%03d", F.pmod(F.xxhash64(name), F.lit(BUCKETS)))
    raise ValueError(f"unknown layout: {layout}")


def write_forecast_table(table: DataFrame, path: str, fmt: str = "csv", layout: str = "bucket") -> None:
    """Folders by hash of the series, by month or by series; rows by series and time in each file.

    ``series_id`` stays a column, so series whose names share a folder stay apart. Rows are spread
    by folder, series and year, so a long series is written by several tasks.
    """
    placed = table.withColumn("part", _folder(layout, F.col("timestamp")))
    spread = placed.repartition("part", "series_id", F.year("timestamp"))
    spread = spread.sortWithinPartitions("part", "series_id", "timestamp")
    spread.write.mode("overwrite").partitionBy("part").option("header", True).format(fmt).save(path)


def _cell(score: Column) -> Column:
    """Three decimals, or N/A when there is no score."""
    return F.coalesce(F.when(score.isNotNull(), F.format_string("%.3f", score)), F.lit("N/A"))


def report_lines(comparison: DataFrame, models: Sequence[str]) -> DataFrame:
    """One text line per series and metric: label, score of each model, best model."""
    label = F.lit(None).cast("string")
    place = F.lit(None).cast("int")
    for i, (metric, text) in enumerate(METRIC_LABELS.items()):
        label = F.when(F.col("metric") == metric, F.lit(text)).otherwise(label)
        place = F.when(F.col("metric") == metric, F.lit(i + 1)).otherwise(place)
    # Column widths of the report.
    cells = [F.rpad(label, 12, " "), *[F.rpad(_cell(F.col(m)), 15, " ") for m in models], F.rpad("best_model", 15, " ")]
    return comparison.select("series_id", place.alias("line_no"), F.rtrim(F.concat_ws(" ", *cells)).alias("line"))


def with_improvement_text(gains: DataFrame) -> DataFrame:
    """Add the signed percentage as text; N/A when undefined."""
    text = F.coalesce(
        F.when(F.col("improvement").isNotNull(), F.format_string("%+.1f%%", F.col("improvement"))), F.lit("N/A")
    )
    return gains.withColumn("improvement_text", text)


def report_with_header(lines: DataFrame, models: Sequence[str]) -> DataFrame:
    """Report lines of every series under a title and the column names, with notes below them."""
    # Column widths of the report.
    head = " ".join(["Metric".ljust(12), *[m.ljust(15) for m in models], "Best model".ljust(15)]).rstrip()
    last = len(METRIC_LABELS)
    notes = [
        (-3, None),
        (-2, "=" * len(head)),
        (-1, head),
        (0, "-" * len(head)),
        (last + 1, "-" * len(head)),
        (last + 2, "Lower is better. N/A: no score, or an actual of zero in MAPE."),
    ]
    title = F.concat(F.lit("Model comparison: "), F.col("series_id").cast("string"))
    around = [
        F.struct(F.lit(no).alias("line_no"), (title if text is None else F.lit(text)).alias("line")) for no, text in notes
    ]
    series = lines.select("series_id").distinct()
    framed = series.select("series_id", F.inline(F.array(*around)))
    return lines.select("series_id", "line_no", "line").unionByName(framed)


def write_report(lines: DataFrame, path: str, models: Sequence[str] = (), layout: str = "bucket") -> None:
    """Report as tab-separated text files of series, line number and line, in order.

    With ``models`` every series gets a title, a header that names them, and notes.
    """
    lines = report_with_header(lines, models) if models else lines
    # A series has a handful of lines.
    placed = lines.withColumn("part", _folder(layout))
    spread = placed.repartition("part").sortWithinPartitions("part", "series_id", "line_no")
    spread.select("part", "series_id", "line_no", "line").write.mode("overwrite").partitionBy("part").option(
        "sep", "\t"
    ).option("quote", "").csv(path)
