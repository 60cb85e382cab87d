"""Time functions on zone-less timestamps. None of them reads the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "shift_hours", "calendar_day", "to_time_strict", "to_time_coerce", "clamp_timestamp",
    "out_of_range", "before_year", "on_day", "parse_ymd", "days_before", "at",
]

# The range of a 64-bit nanosecond clock, at microsecond precision.
MIN_TIME = "1677-09-21 00:12:43.145225"
MAX_TIME = "2262-04-11 23:47:16.854775"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(moment: datetime | date | str) -> Column:
    """Zone-less timestamp literal."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def shift_hours(c: Column | str, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours), _col(c))


def calendar_day(c: Column | str) -> Column:
    """Calendar day. For a filter use a range on the bare column, which reaches the scan."""
    return F.to_date(_col(c))


def parse_ymd(c: Column | str) -> Column:
    """Date from ``yyyymmdd`` text."""
    return F.to_date(_col(c), "yyyyMMdd")


def days_before(c: Column | str, days: int) -> Column:
    return F.date_sub(_col(c), days)


def out_of_range(c: Column | str) -> Column:
    c = _col(c)
    return (c < at(MIN_TIME)) | (c > at(MAX_TIME))


def to_time_strict(c: Column | str) -> Column:
    """Timestamp; unreadable or out-of-range text fails the job, whatever the ANSI setting."""
    c = _col(c)
    parsed = c.try_cast("timestamp_ntz")
    bad = c.isNotNull() & (parsed.isNull() | out_of_range(parsed))
    return F.when(bad, F.raise_error(F.concat(F.lit("not a timestamp: "), c.cast("string")))).otherwise(parsed)


def to_time_coerce(c: Column | str) -> Column:
    """Timestamp; unreadable or out-of-range values become NULL."""
    parsed = _col(c).try_cast("timestamp_ntz")
    return F.when(~out_of_range(parsed), parsed)


def clamp_timestamp(c: Column | str) -> Column:
    """Values outside the range become its upper end; NULL stays NULL."""
    c = _col(c)
    return F.when(out_of_range(c), at(MAX_TIME)).otherwise(c)


def before_year(c: Column | str, year: int) -> Column:
    """``year(c) < year`` as a bound on the bare column."""
    return _col(c) < at(datetime(year, 1, 1))


def on_day(c: Column | str, day: date) -> Column:
    """``date(c) = day`` as a range on the bare column."""
    c = _col(c)
    first = datetime(day.year, day.month, day.day)
    return (c >= at(first)) & (c < F.timestamp_add("DAY", F.lit(1), at(first)))
