"""Time helpers. All arithmetic is exact integer microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_SECOND = 1_000_000
_UNITS = {
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def duration_micros(text: str | int) -> int:
    """``"10 seconds"`` / ``"1 hour"`` / ``"5 s"`` -> microseconds (ints pass through)."""
    if isinstance(text, int):
        return text
    amount, unit = text.strip().split()
    return int(amount) * _UNITS[unit.lower()]


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_micros(ts: str | Column) -> Column:
    """Epoch microseconds of a timestamp column (NTZ is read in the session zone, UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def from_micros(us: str | Column, ntz: bool = True) -> Column:
    """Timestamp from epoch microseconds; NTZ by default so it matches the input tables."""
    t = F.timestamp_micros(_c(us))
    return t.cast("timestamp_ntz") if ntz else t


def floor_to(us: Column, step_us: int) -> Column:
    """Largest multiple of ``step_us`` <= ``us`` (correct for negative instants too)."""
    return us - F.pmod(us, F.lit(step_us))


def next_midnight(ts: str | Column, period: str | int = "1 day") -> Column:
    """The first period boundary (UTC midnight for a day) strictly after ``ts``.

    ``(t / day + 1) * day`` in epoch time; returns the input's NTZ type.
    """
    step = duration_micros(period)
    return from_micros(floor_to(to_micros(ts), step) + F.lit(step))
