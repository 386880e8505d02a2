"""Dates and seasons as Column expressions. "Today" is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import blank_to_null, trimmed


def timestamp(c: Column) -> Column:
    """Year-month-day hour:minute:second, also with single digits; the all-zero mark and anything else give null."""
    return F.try_to_timestamp(trimmed(c), F.lit("yyyy-M-d H:m:s"))


def day_of(c: Column) -> Column:
    return F.to_date(timestamp(c))


def day(c: Column, *formats: str) -> Column:
    """First format that fits, "Jul 4, 2025" by default."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(trimmed(c), F.lit(f))) for f in formats or ("MMM d, yyyy",)])


def member_since(c: Column) -> Column:
    return day(c, "yyyy-M-d", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy")


def age(born: Column, today: Column) -> Column:
    """Whole years, counted at birthdays."""
    late = F.date_format(today, "MMdd").cast("int") < F.date_format(born, "MMdd").cast("int")
    return F.year(today) - F.year(born) - late.cast("int")


def is_minor(born: Column, today: Column) -> Column:
    return age(born, today) < 18


def in_window(start: Column, today: Column, days: int) -> Column:
    return start.between(today, F.date_add(today, days))


def tag_year(c: Column) -> Column:
    """Digits after the last underscore."""
    return blank_to_null(F.regexp_extract(c, r"_(\d+)$", 1)).try_cast("int")


def lone_year(c: Column) -> Column:
    """First 20xx that isn't part of a longer number."""
    return blank_to_null(F.regexp_extract(c, r"(?<![0-9])(20\d{2})(?![0-9])", 1)).try_cast("int")


def word_year(c: Column) -> Column:
    """First 20xx that is a word."""
    return blank_to_null(F.regexp_extract(c, r"\b(20\d{2})\b", 1)).try_cast("int")


def without_year(c: Column) -> Column:
    return trimmed(F.regexp_replace(trimmed(c), r"^\d{4}\s*", ""))
