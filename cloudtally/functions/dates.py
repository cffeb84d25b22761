"""Month keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(month: Column) -> Column:
    """``'YYYY-MM'`` text to the DATE of its first day; NULL where the text is not a month.

    A cast parses a date several times faster than a pattern does, but would also take ``2025-1``; hence
    the test of the shape.
    """
    shaped = (F.length(month) == 7) & (F.substring(month, 5, 1) == "-")
    return F.when(shaped, F.concat(month, F.lit("-01")).try_cast("date"))


def month_text(date: Column) -> Column:
    """A DATE to its ``'YYYY-MM'`` text."""
    return F.substring(date.cast("string"), 1, 7)


def quarter_label(date: Column) -> Column:
    """``'YYYY-Qn'``."""
    return F.concat(F.date_format(date, "yyyy"), F.lit("-Q"), F.quarter(date).cast("string"))


def month_number_key(date: Column) -> Column:
    """The month as an integer YYYYMM."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def peak_flag(date: Column, peak_months: tuple[int, ...]) -> Column:
    """1 in a peak month, 0 in any other, NULL without a date."""
    return F.when(date.isNull(), None).otherwise(F.month(date).isin(*peak_months).cast("int"))


def parse_day(text: Column, pattern: str) -> Column:
    """A DATE from text, NULL for blanks and for days that do not exist."""
    return F.try_to_date(F.nullif(text, F.lit("")), pattern)
