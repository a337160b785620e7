"""Feed days as text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    """``2025-10-01`` to a DATE; NULL when the text is no date."""
    return F.try_to_date(text, "yyyy-MM-dd")


def feed_key(day: Column) -> Column:
    """A DATE to ``20251001``, as used in archive and directory names."""
    return F.date_format(day, "yyyyMMdd")


def month_key(day: Column) -> Column:
    """A DATE to ``2025-10``, the name of a monthly dataset."""
    return F.date_format(day, "yyyy-MM")


def day_count(start: Column, end: Column) -> Column:
    """Days from start to end, both included."""
    return (F.datediff(end, start) + 1).cast("bigint")


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def days_between(start: Column, end: Column) -> Column:
    """All days from start to end as an array; empty when start is after end."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
