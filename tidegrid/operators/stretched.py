"""Regular tables that carry their stretches.

A stretch is a piece of a series of bounded length. Written down, it is the readings that the
piece and the ``reach`` rows before it lie between, so its size follows the readings and not the
grid. Read, it is expanded to grid rows, and every row has the values of its stretch beside it in
one array: a lag is an element of that array, so no grid row is shuffled, sorted or written.

Such a table is a regular table with a few more columns, ``COLUMNS``. Operators that know them use
the array, others work on the rows as on any regular table. Filters on series or positions keep the
columns right.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timegrid import slot_start
from tidegrid.operators.chunked import dealt
from tidegrid.session import saved
from tidegrid.spec import Spec

#: Values of the stretch and the rows before it, the position of the first of them, and the stretch itself.
COLUMNS = ("_near", "_near_from", "_first", "_readings")


def columns(df: DataFrame) -> list[str]:
    """The columns that carry stretches, none for other tables."""
    return list(COLUMNS) if "_near" in df.columns else []


def reaches(df: DataFrame, rows: int) -> bool:
    """Whether every row has the ``rows`` rows before it beside it."""
    return "_near" in df.columns and df.schema["_near"].metadata["reach"] >= rows


def back(k: Column | int) -> Column:
    """The value ``k`` rows before the row, NULL where the series has no such row."""
    return F.get("_near", (F.col("pos") - F.col("_near_from") - k).cast("int"))


def newest(rows: int) -> Column:
    """The ``rows`` values up to and with the row, oldest first."""
    return F.slice("_near", (F.col("pos") - F.col("_near_from") - rows + 2).cast("int"), F.lit(rows))


def cut(near: DataFrame, spec: Spec, reach: int) -> DataFrame:
    """Stretches of bins with their neighbours (``with_neighbours`` on ``slot`` and ``value``).

    A reading has the position ``a`` and the value ``v``, stands for all rows up to ``b``, and leads
    to the value ``w`` of the next one. It goes to every stretch that has one of these rows, or has
    one of them within its reach.
    """
    span = max(spec.chunk, 4 * reach)
    a = F.col("slot") - F.col("first_at")
    b = F.coalesce(F.col("next_at") - 1, F.col("slot")) - F.col("first_at")
    n = F.col("last_at") - F.col("first_at") + 1
    parts = F.sequence(F.floor(a / F.lit(span)), F.floor(F.least(b + F.lit(reach), n - 1) / F.lit(span)))
    rows = near.select(
        "series_id", n.alias("n"), F.col("first_at").alias("_first"), F.explode(parts).alias("_part"),
        F.struct(a.alias("a"), b.alias("b"), F.col("value").alias("v"), F.col("value_next").alias("w")).alias("r"),
    )
    listed = rows.groupBy("series_id", "_part", "n", "_first").agg(F.sort_array(F.collect_list("r")).alias("_readings"))
    kept = F.col("_readings").alias("_readings", metadata={"reach": reach, "span": span})
    return listed.select("series_id", "_part", "n", "_first", kept)


def rows_of(parts: DataFrame, spec: Spec, extra: Sequence[str] = (), scale: Callable[[Column], Column] | None = None) -> DataFrame:
    """The regular table of stretches; ``extra`` names columns of ``parts`` to keep, ``scale`` maps the values."""
    known = parts.schema["_readings"].metadata
    reach, span = known["reach"], known["span"]
    lo = F.col("_part") * F.lit(span)
    hi = F.least(lo + F.lit(span), F.col("n")) - 1
    begin = F.greatest(lo - F.lit(reach), F.lit(0).cast("bigint"))

    def line(p: Column, a: Column, v: Column, rise: Column, steps: Column) -> Column:
        """The value at ``p``, by the same steps as in ``filled_value``; the last reading stands for its own row only."""
        value = F.when(p == a, v).otherwise(v + rise * ((p - a) / steps))
        return value if scale is None else scale(value)

    # What is the same for all rows of a reading is worked out once.
    inside = F.filter("_readings", lambda r: (r["a"] <= hi) & (r["b"] >= begin))
    ramps = F.transform(
        inside,
        lambda r: F.struct(
            F.greatest(r["a"], begin).alias("s"), F.least(r["b"], hi).alias("e"), r["a"].alias("a"), r["v"].alias("v"),
            (r["w"] - r["v"]).alias("rise"), (r["b"] + 1 - r["a"]).cast("double").alias("steps"),
        ),
    )
    near = F.flatten(
        F.transform(
            ramps, lambda r: F.transform(F.sequence(r["s"], r["e"]), lambda p: line(p, r["a"], r["v"], r["rise"], r["steps"]))
        )
    )
    arrays = parts.select(
        "series_id", "n", "_first", "_readings", *extra, lo.alias("_lo"), hi.alias("_hi"), begin.alias("_near_from"),
        near.alias("_near", metadata={"reach": reach}),
    )
    start, stop = F.greatest("a", "_lo"), F.least("b", "_hi")
    rows = arrays.select("*", F.inline("_readings")).where(start <= stop).withColumn("pos", F.explode(F.sequence(start, stop)))
    value = line(F.col("pos"), F.col("a"), F.col("v"), F.col("w") - F.col("v"), F.col("b") + 1 - F.col("a"))
    return rows.select(
        "series_id", slot_start(F.col("_first") + F.col("pos"), spec.step).alias("ts"), value.alias("value"),
        "pos", "n", (F.col("pos") != F.col("a")).alias("filled"), *extra, *COLUMNS,
    )


def heads(df: DataFrame) -> DataFrame:
    """The stretches of a table that carries them. A stretch is known by its last row, which tails have too."""
    span = df.schema["_readings"].metadata["span"]
    last = (F.col("pos") % F.lit(span) == span - 1) | (F.col("pos") == F.col("n") - 1)
    return df.where(last).select("series_id", F.floor(F.col("pos") / F.lit(span)).alias("_part"), "n", "_first", "_readings")


def saved_rows(df: DataFrame, spec: Spec) -> DataFrame:
    """``saved`` for a table that carries its stretches: they are written, the grid rows are not."""
    return rows_of(saved(heads(df)), spec)


def scaled_rows(df: DataFrame, scaler: DataFrame, feature: str, spec: Spec, scale: Callable[[Column, str], Column]) -> DataFrame:
    """Values scaled by the one row that ``scaler`` has of a series; its columns are kept.

    Meets the stretches, not the rows. ``scaler`` is repeated for every stretch, so that no key is
    a whole series.
    """
    span = df.schema["_readings"].metadata["span"]
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.lit(span)))
    per = scaler.withColumn("_part", F.explode(numbers)).drop("n", "n_rows")
    extra = [c for c in per.columns if c not in ("series_id", "_part")]
    joined = heads(df).join(dealt(per), ["series_id", "_part"])
    return rows_of(joined, spec, extra, lambda v: scale(v, feature))
