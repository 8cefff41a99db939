"""Boundaries of epoch seconds (long columns, UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_to(t: Column, seconds: int) -> Column:
    """The last multiple of so many seconds. 10: bins of the short groups; 60: minutes; 120: bins of the long groups; 900 and 10800: group windows."""
    return t - F.pmod(t, F.lit(seconds))


def second_boundary(t: Column, seconds: int) -> Column:
    """Within the minute."""
    return t - F.pmod(F.pmod(t, F.lit(60)), F.lit(seconds))


def minute_boundary(t: Column, minutes: int) -> Column:
    """Within the hour."""
    minute = floor_to(t, 60)
    return minute - F.pmod(F.pmod(F.floor(t / 60), F.lit(60)), F.lit(minutes)) * 60


def hour_boundary(t: Column, hours: int) -> Column:
    """Within the day."""
    return floor_to(t, 3600) - F.pmod(F.pmod(F.floor(t / 3600), F.lit(24)), F.lit(hours)) * 3600


def chunk_boundary(t: Column, seconds: int) -> Column:
    return second_boundary(t, seconds) if seconds < 60 else minute_boundary(t, seconds // 60)


def window_boundary(t: Column, minutes: int) -> Column:
    return minute_boundary(t, minutes) if minutes < 60 else hour_boundary(t, minutes // 60)


def bin_of(t: Column, window_seconds: int, bins: int = 90) -> Column:
    """Number of the bin in its window."""
    return F.floor(F.pmod(t, F.lit(window_seconds)) / (window_seconds // bins)).cast("int")


def whole_days(first: Column, last: Column) -> Column:
    return F.floor((last - first) / 86400).cast("long")


def milliseconds(micros: Column) -> Column:
    return F.round(micros / 1000.0, 3)
