"""Date and time helpers. ``as_of`` is always given, never read from the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Programme start dates.
MOVE_IN_COLLECTED_FROM = "2017-10-01"
COHORT_START = "2014-06-01"


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def excel_date(serial: Column) -> Column:
    """Spreadsheet day number, counted from 1899-12-30, to a date; null where it is no number."""
    return F.date_add(day("1899-12-30"), F.floor(serial.try_cast("double")).try_cast("int"))


def parse_dt(text: Column) -> Column:
    """Timestamp from text, null where it does not parse."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(text, F.lit("M/d/yyyy H:mm:ss")),
        F.try_to_timestamp(text, F.lit("M/d/yyyy")),
    )


def date_or_fallback(text: Column, fallback: Column) -> Column:
    """Parsed timestamp, else another date."""
    return F.coalesce(parse_dt(text), fallback.cast("timestamp"))


def as_of_exit(exit_date: Column, as_of: Column) -> Column:
    """A missing or later exit counts as the as-of day."""
    return F.least(F.coalesce(exit_date, as_of), as_of)


def stamp_export_id(as_of: Column) -> Column:
    """Day as the number yyyymmdd."""
    return F.date_format(as_of, "yyyyMMdd").cast("int")


def days_between(later: Column, earlier: Column) -> Column:
    """Signed difference in days, with fractions."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(86_400_000_000.0)


def as_day_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def as_time_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def open_status(end: Column, as_of: Column) -> Column:
    """1 while the end is missing or after the as-of day, else 0."""
    return F.when(end.isNull() | (end > as_of), 1).otherwise(0)
