"""Column expressions for grid arithmetic.

A *slot* is the number of whole steps between the epoch and a stamp. Slots are
plain bigints, so joins, sorts and hashes on them are cheap and free of time zones
(the session zone is pinned to UTC).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slot_of(ts: Column | str, step: int) -> Column:
    """Slot that contains ``ts`` (bins are closed on the left)."""
    seconds = F.unix_seconds(_col(ts).cast("timestamp"))
    return ((seconds - F.pmod(seconds, F.lit(step))) / step).cast("bigint")


def slot_start(slot: Column | str, step: int) -> Column:
    """Zone-less stamp at which ``slot`` starts."""
    return F.timestamp_seconds(_col(slot) * F.lit(step)).cast("timestamp_ntz")


def floor_to_step(ts: Column | str, step: int) -> Column:
    return slot_start(slot_of(ts, step), step)


def ceil_slot(ts: Column | str, step: int) -> Column:
    """First slot that starts at or after ``ts``."""
    ragged = F.pmod(F.unix_micros(_col(ts).cast("timestamp")), F.lit(step * 1_000_000)) != 0
    return slot_of(ts, step) + ragged.cast("bigint")


def ceil_to_step(ts: Column | str, step: int) -> Column:
    return slot_start(ceil_slot(ts, step), step)


def on_grid(ts: Column | str, step: int) -> Column:
    """True when the stamp is exactly the start of a slot."""
    return F.pmod(F.unix_micros(_col(ts).cast("timestamp")), F.lit(step * 1_000_000)) == 0


def shift(ts: Column | str, steps: Column, step: int) -> Column:
    """``ts`` moved by a number of steps."""
    return _col(ts) + F.make_dt_interval(secs=(steps * F.lit(step)).cast("decimal(18,6)"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
