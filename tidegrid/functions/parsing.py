"""Tolerant parsing: a cell that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first layouts, most specific first, then ISO ones. Single letters take one
# or two digits; brackets are optional parts.
DAY_FIRST_FORMATS = (
    "d/M/yyyy H:m:s[.SSSSSS][.SSS]",
    "d/M/yyyy H:m",
    "d/M/yyyy",
    "yyyy-M-d['T'][ ]H:m:s[.SSSSSS][.SSS]",
    "yyyy-M-d['T'][ ]H:m",
    "yyyy-M-d",
)


def parse_timestamp(text: Column, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Zone-less stamp from text, trying ``formats`` in order."""
    tries = [F.try_to_timestamp(F.trim(text), F.lit(f)) for f in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_decimal(text: Column) -> Column:
    """Double from text that may use a decimal comma; NaN becomes NULL."""
    return nan_to_null(F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double"))


def nan_to_null(value: Column) -> Column:
    """NaN means missing in the inputs; Spark's ``avg`` would propagate it."""
    return F.when(~F.isnan(value), value)


def safe_name(name: Column) -> Column:
    """Name usable as a file name: slash and backslash become underscores."""
    return F.translate(name, "/\\", "__")
