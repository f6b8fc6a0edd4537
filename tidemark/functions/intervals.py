"""Column expressions over half-open date ranges [valid_from, valid_to); a null end is open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains(start: Column, end: Column, day: Column) -> Column:
    return (start <= day) & (end.isNull() | (day < end))


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (b_end.isNull() | (a_start < b_end)) & (a_end.isNull() | (b_start < a_end))


def clip(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> tuple[Column, Column]:
    """Intersection of two ranges; ``least`` skips an open end."""
    return F.greatest(a_start, b_start), F.least(a_end, b_end)


def last_day(end: Column) -> Column:
    """The inclusive last day of a range with this exclusive end."""
    return F.date_sub(end, 1)


def is_inverted(start: Column, end: Column) -> Column:
    return F.coalesce(end <= start, F.lit(False))
