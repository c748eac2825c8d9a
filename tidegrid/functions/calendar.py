"""Calendar features of a stamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_day(ts: Column) -> Column:
    """Hour with its fraction, 13:30 -> 13.5."""
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


def day_of_week(ts: Column) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(ts).cast("double")


def day_of_year(ts: Column) -> Column:
    return F.dayofyear(ts).cast("double")


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def cycle(value: Column, length: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle of ``length``."""
    angle = F.lit(2 * math.pi) * value / F.lit(float(length))
    return F.sin(angle), F.cos(angle)


def calendar_columns(ts: Column) -> dict[str, Column]:
    hour, day = hour_of_day(ts), day_of_week(ts)
    hour_sin, hour_cos = cycle(hour, 24)
    day_sin, day_cos = cycle(day, 7)
    return {
        "hour_of_day": hour,
        "day_of_week": day,
        "day_of_year": day_of_year(ts),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "day_sin": day_sin,
        "day_cos": day_cos,
    }
