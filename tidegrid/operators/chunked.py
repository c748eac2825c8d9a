"""Ordered operations over series that may be too long for one task.

A window over ``partitionBy('series_id')`` puts a whole series into one task. The
helpers here cut a series into time chunks, run the window inside each chunk, and
carry what crosses a chunk border through a small table with one row per chunk.
Three shapes cover every ordered operator of the package:

* ``with_neighbours``: nearest non-null values before and after each row,
* ``with_position``: running row number and row count,
* ``with_halo``: frames of bounded width, by copying border rows to the next chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = "_chunk"


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join whose sides both grow with the data: both are dealt over the tasks by key.

    Spark takes sizes from the files read. Rows that a grid, a list or a saved table adds to them do
    not show, so it would take large sides for small ones and send them whole through the driver.
    """
    return df.hint("merge")


def _split(df: DataFrame, by: Sequence[str], at: str, span: int) -> DataFrame:
    """Shuffle once by (series, chunk); the window and the edges both read this shuffle.

    Rows without a series are dropped here and the chunk is never NULL. Otherwise the
    join of the two branches would add null checks to one of them only, the shuffles
    would differ, and Spark could not reuse one for both.
    """
    for key in by:
        df = df.where(F.col(key).isNotNull())
    chunk = F.coalesce(F.floor(F.col(at) / F.lit(span)), F.lit(0))
    return df.withColumn(CHUNK, chunk).repartition(*by, CHUNK)


def _presence(df: DataFrame, by: Sequence[str], at: str) -> list[Column]:
    """Per chunk and column: whether any row has a value. See ``_join_edges``."""
    return [F.max(F.col(c).isNotNull()).alias(f"_some_{c}") for c in df.columns if c not in (*by, at)]


def _join_edges(inside: DataFrame, edges: DataFrame, df: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    """Join rows with the edges of their chunk.

    The condition "a row with a value implies a chunk with a value" always holds. It
    makes both branches read the same columns, whatever the caller uses of the result.
    Otherwise Spark prunes them differently, the shuffles are no longer equal, and
    everything before them, scans included, runs twice.
    """
    keys = [*by, CHUNK]
    edges = edges.withColumnsRenamed({k: f"_edge_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_edge_{k}"))
    for c in df.columns:
        if c not in (*by, at):
            on = on & (F.col(c).isNull() | F.col(f"_some_{c}"))
    return inside.join(dealt(edges), on)


def _ignore_nulls(fn: str, col: str, by: Sequence[str], order: Sequence[str]) -> Column:
    keys = ", ".join(f"`{c}`" for c in by)
    rank = ", ".join(f"`{c}`" for c in order)
    return F.expr(f"{fn}(`{col}`) IGNORE NULLS OVER (PARTITION BY {keys} ORDER BY {rank})")


def with_neighbours(
    df: DataFrame,
    cols: Sequence[str],
    *,
    at: str,
    span: int,
    by: Sequence[str] = ("series_id",),
    tie: Sequence[str] = (),
    forward: bool = True,
    extent: bool = False,
) -> DataFrame:
    """Add, for every column, its nearest non-null neighbours in ``at`` order.

    ``<c>_prev``/``<c>_prev_at`` is the last non-null value at or before the row,
    ``<c>_next``/``<c>_next_at`` the first one after it (``forward`` only).
    ``next_at`` is the position of the next row, ``first_at`` and ``last_at`` are the
    bounds of the series, and with ``extent`` ``<c>_first_at`` and ``<c>_last_at`` those
    of the non-null values of a column. ``at`` must be a bigint, and rows with a value must not share
    one; ``tie`` orders rows without a value among them.
    """
    by, tie = list(by), list(tie)
    chunk = [*by, CHUNK]
    parts = _split(df, by, at, span)

    # Edges: one row per chunk, then a window over the chunks of a series.
    aggs = [F.min(at).alias("_lo"), F.max(at).alias("_hi"), *_presence(df, by, at)]
    for c in cols:
        spot = F.when(F.col(c).isNotNull(), F.col(at))
        aggs += [F.max_by(c, spot).alias(f"_{c}_hi"), F.max(spot).alias(f"_{c}_hi_at")]
        if forward:
            aggs.append(F.min_by(c, spot).alias(f"_{c}_lo"))
        if forward or extent:
            aggs.append(F.min(spot).alias(f"_{c}_lo_at"))
    edges = parts.groupBy(*chunk).agg(*aggs)
    whole = W.partitionBy(*by)
    picks = [F.min("_lo").over(whole).alias("first_at"), F.max("_hi").over(whole).alias("last_at")]
    if forward:
        picks.append(_ignore_nulls("lead", "_lo", by, [CHUNK]).alias("_after"))
    for c in cols:
        if extent:
            picks += [
                F.min(f"_{c}_lo_at").over(whole).alias(f"{c}_first_at"),
                F.max(f"_{c}_hi_at").over(whole).alias(f"{c}_last_at"),
            ]
        for part in ("", "_at"):
            picks.append(_ignore_nulls("lag", f"_{c}_hi{part}", by, [CHUNK]).alias(f"_{c}_before{part}"))
            if forward:
                picks.append(_ignore_nulls("lead", f"_{c}_lo{part}", by, [CHUNK]).alias(f"_{c}_after{part}"))
    edges = edges.select(*chunk, *[c for c in edges.columns if c.startswith("_some_")], *picks)

    # Inside the chunks: one sort serves every function.
    order = [at, *tie]
    w = W.partitionBy(*chunk).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = parts.select(
        "*", *[F.when(F.col(c).isNotNull(), F.col(at)).alias(f"_{c}_spot") for c in cols]
    )
    local = []
    for c in cols:
        local += [F.last(c, True).over(upto).alias(f"_{c}_p"), F.last(f"_{c}_spot", True).over(upto).alias(f"_{c}_p_at")]
        if forward:
            local += [
                _ignore_nulls("lead", c, chunk, order).alias(f"_{c}_n"),
                _ignore_nulls("lead", f"_{c}_spot", chunk, order).alias(f"_{c}_n_at"),
            ]
    if forward:
        local.append(F.lead(at).over(w).alias("_n_row"))
    inside = marked.select("*", *local)

    # The carried value applies only where the chunk itself has none.
    out = [F.col(c) for c in df.columns] + [F.col("first_at"), F.col("last_at")]
    if forward:
        out.append(F.coalesce("_n_row", "_after").alias("next_at"))
    for c in cols:
        if extent:
            out += [F.col(f"{c}_first_at"), F.col(f"{c}_last_at")]
        sides = [("prev", "p", "before")] + ([("next", "n", "after")] if forward else [])
        for side, here, there in sides:
            # A null spot decides; the value of a found spot is never null.
            for part in ("", "_at"):
                out.append(F.coalesce(f"_{c}_{here}{part}", f"_{c}_{there}{part}").alias(f"{c}_{side}{part}"))
    return _join_edges(inside, edges, df, by, at).select(*out)


def with_position(
    df: DataFrame, *, at: str, span: int, by: Sequence[str] = ("series_id",)
) -> DataFrame:
    """Add ``pos`` (0-based row number in ``at`` order) and ``n`` (rows of the series)."""
    by = list(by)
    chunk = [*by, CHUNK]
    df = df.drop("pos", "n")
    parts = _split(df, by, at, span)
    sizes = parts.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_rows"), *_presence(df, by, at))
    before = W.partitionBy(*by).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *chunk,
        *[c for c in sizes.columns if c.startswith("_some_")],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(W.partitionBy(*by)).alias("n"),
    )
    rank = F.row_number().over(W.partitionBy(*chunk).orderBy(at))
    inside = parts.withColumn("_rank", rank)
    return _join_edges(inside, offsets, df, by, at).select(
        *df.columns, (F.col("_offset") + F.col("_rank") - 1).alias("pos"), "n"
    )


def with_halo(
    df: DataFrame,
    before: int,
    after: int,
    exprs: dict[str, Column],
    *,
    span: int,
    by: Sequence[str] = ("series_id",),
) -> DataFrame:
    """Evaluate frames that reach ``before`` rows back and ``after`` rows ahead.

    ``exprs`` maps names to functions of a window spec. Rows near a chunk border are
    copied into the neighbour chunk, so frames are complete and one shuffle suffices.
    ``df`` needs ``pos`` and ``n``. The chunk is widened when a frame is long, which
    keeps the copies a small share of the rows.
    """
    span = max(span, 4 * (before + after))
    home = F.floor(F.col("pos") / F.lit(span))
    lowest = F.floor(F.greatest(F.col("pos") - F.lit(after), F.lit(0)) / F.lit(span))
    highest = F.floor(F.least(F.col("pos") + F.lit(before), F.col("n") - 1) / F.lit(span))
    copies = df.withColumn(CHUNK, F.explode(F.sequence(lowest, highest)))
    w = W.partitionBy(*by, CHUNK).orderBy("pos")
    framed = copies.select("*", *[make(w).alias(name) for name, make in exprs.items()])
    return framed.where(F.col(CHUNK) == home).drop(CHUNK)


def explode_slots(df: DataFrame, start: Column, stop: Column, span: int, name: str) -> DataFrame:
    """One row per slot from ``start`` to ``stop``.

    Exploded in two levels, so that no array holds more than ``span`` elements even
    when the gap is very long.
    """
    block = F.sequence(F.floor(start / F.lit(span)), F.floor(stop / F.lit(span)))
    lo = F.greatest(start, F.col("_block") * F.lit(span))
    hi = F.least(stop, (F.col("_block") + 1) * F.lit(span) - 1)
    return (
        df.where(start <= stop)
        .withColumn("_block", F.explode(block))
        .withColumn(name, F.explode(F.sequence(lo, hi)))
        .drop("_block")
    )
