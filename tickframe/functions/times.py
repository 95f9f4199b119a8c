"""Time arithmetic on bigint microseconds since the epoch (session zone UTC)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F

DAY_US = 86_400_000_000


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_us(d: timedelta) -> int:
    """A duration as whole microseconds."""
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


def micros(c: str | Column) -> Column:
    """Timestamp (with or without zone) to epoch microseconds."""
    return F.unix_micros(as_col(c).cast("timestamp"))


def from_micros(c: str | Column) -> Column:
    """Epoch microseconds to TIMESTAMP_NTZ."""
    return F.timestamp_micros(as_col(c)).cast("timestamp_ntz")


def floor_us(us: Column, every: timedelta) -> Column:
    """Truncate epoch microseconds down to a multiple of ``every``."""
    return us - F.pmod(us, F.lit(to_us(every)))


def shift(c: str | Column, by: timedelta) -> Column:
    """Timestamp plus a fixed duration, as TIMESTAMP_NTZ."""
    return from_micros(micros(c) + F.lit(to_us(by)))


def truncate(c: str | Column, every: timedelta) -> Column:
    """Timestamp truncated to an arbitrary interval, as TIMESTAMP_NTZ."""
    return from_micros(floor_us(micros(c), every))


def interval_us(c: str | Column) -> Column:
    """A day-time interval as bigint microseconds."""
    c = as_col(c)
    return micros(F.timestamp_micros(F.lit(0)) + c)


def day_points(date: str | Column, every: timedelta) -> Column:
    """The points of one day at a fixed step, left-closed, as an array of TIMESTAMP_NTZ."""
    start = micros(as_col(date).cast("timestamp"))
    steps = F.sequence(F.lit(0), F.lit((DAY_US - 1) // to_us(every)))
    return F.transform(steps, lambda i: from_micros(start + i.cast("long") * F.lit(to_us(every))))


# Fixed value: files of the spot market switch from milliseconds to microseconds at this date.
SPOT_MICROS_SINCE = "2025-01-01"
SPOT_CUTOFF_MS = 1_735_689_600_000


def spot_stamp_us(stamp: str | Column) -> Column:
    """Spot stamps: milliseconds before the cutoff date, microseconds from it on.

    A value counts as microseconds when it is at or past the cutoff and has more than 13
    digits, so a late millisecond stamp is not misread.
    """
    s = as_col(stamp)
    is_us = (s >= F.lit(SPOT_CUTOFF_MS)) & (s >= F.lit(10**13))
    return F.when(is_us, s).otherwise(s * F.lit(1000))


def futures_stamp_us(stamp: str | Column) -> Column:
    """Futures stamps are always milliseconds."""
    return as_col(stamp) * F.lit(1000)
