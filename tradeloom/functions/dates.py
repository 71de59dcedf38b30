"""Dates: age, offsets, building from parts, strict and tolerant parsing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_years(born: Column, as_of: date) -> Column:
    """Completed years between `born` and `as_of`.

    Compares month and day, so a birthday on 29 February counts from 1 March in ordinary years.
    """
    birthday = F.month(born) * 100 + F.dayofmonth(born)
    today = as_of.month * 100 + as_of.day
    return F.lit(as_of.year) - F.year(born) - (birthday > today).cast("int")


def months_before(as_of: date, months: int) -> Column:
    return F.add_months(F.lit(as_of), -months)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date of the three numbers; NULL for a day that does not exist (ANSI `make_date` would fail)."""
    text = F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string")
    )
    return text.try_cast("date")


def strict_us_date(text: Column) -> Column:
    """`month/day/year`; a value that is no date fails the query."""
    return F.to_date(text, "M/d/yyyy")


def tolerant_date(text: Column) -> Column:
    """`year-month-day`; a value that is no date becomes NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")
