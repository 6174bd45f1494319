"""Date and time columns. Change logs carry seconds, application logs milliseconds: one helper for each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DATE_COMPACT = "yyyyMMdd"


def et_from_seconds(ts: Column) -> Column:
    return F.timestamp_seconds(ts)


def et_from_millis(ts: Column) -> Column:
    return F.timestamp_millis(ts)


def date_id(text: Column) -> Column:
    """Day of a date-time text; NULL when the text does not parse."""
    return F.date_format(F.try_to_timestamp(text, F.lit(DATE_TIME)), DATE)


def datetime_to_ms(text: Column, tz: str = "+08:00") -> Column:
    """Epoch milliseconds of a local date-time text in zone ``tz`` (session zone UTC)."""
    return F.unix_millis(F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(DATE_TIME)), tz))


def date_to_ms(text: Column, tz: str = "+08:00") -> Column:
    return datetime_to_ms(F.concat(text, F.lit(" 00:00:00")), tz)


def ms_to_text(ms: Column, pattern: str = DATE, tz: str = "UTC") -> Column:
    """Epoch milliseconds rendered in zone ``tz`` (session zone UTC)."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(ms), tz), pattern)


def compare_dates(left: Column, right: Column) -> Column:
    """1, 0 or -1 as ``left`` is after, on or before ``right`` (both ``yyyy-MM-dd`` texts)."""
    days = F.datediff(F.try_to_timestamp(left, F.lit(DATE)), F.try_to_timestamp(right, F.lit(DATE)))
    return F.signum(days).cast("int")
