"""Fiscal calendar: the year starts on 1 July and is named after the year it ends in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str) -> dt.date:
    """Accept a date, a datetime or an ISO string as an operator parameter."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def fiscal_year(d: Column) -> Column:
    return F.year(d) + F.when(F.month(d) >= 7, 1).otherwise(0)


def fiscal_day(d: Column) -> Column:
    """Day number within the fiscal year; 1 July is day 1. Leap days count."""
    return F.datediff(d, F.make_date(fiscal_year(d) - 1, F.lit(7), F.lit(1))) + 1


def fiscal_year_of(d: dt.date) -> int:
    return d.year + (1 if d.month >= 7 else 0)


def fiscal_day_of(d: dt.date) -> int:
    return (d - dt.date(fiscal_year_of(d) - 1, 7, 1)).days + 1


def is_ytd(d: Column, as_of: dt.date) -> Column:
    """True for dates no later in their own fiscal year than ``as_of`` is in its own."""
    return fiscal_day(d) <= F.lit(fiscal_day_of(as_of))


def add_months_eom(d: Column, months: int) -> Column:
    """Add months; the last day of a month maps to the last day of the target month."""
    moved = F.add_months(d, months)
    return F.when(d == F.last_day(d), F.last_day(moved)).otherwise(moved)
