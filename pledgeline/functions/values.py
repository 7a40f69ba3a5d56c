"""Ratios, null handling and display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Plain quotient as double; NULL where the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def flag(condition: Column) -> Column:
    """A condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def one_of(column: Column, values: list | tuple | set | None) -> Column | None:
    """Membership test, or None when every value is wanted."""
    return None if values is None else column.isin(list(values))


def both(*conditions: Column | None) -> Column:
    """AND of the conditions that are given."""
    result = F.lit(True)
    for condition in conditions:
        if condition is not None:
            result = result & condition
    return result


def text(column: Column) -> Column:
    """Text in which NULL reads as the empty string."""
    return F.coalesce(column, F.lit(""))


def nonblank(column: Column) -> Column:
    """NULL for missing or all-blank text."""
    return F.nullif(F.trim(column), F.lit(""))


def listed_name(last: Column, first: Column) -> Column:
    """``Last, First``."""
    return F.concat(text(last), F.lit(", "), text(first))


def display_name(
    last: Column, first: Column, middle: Column, pers_suffix: Column, prof_suffix: Column
) -> Column:
    """``Last Suffixes, First M.``; a missing or blank part leaves no punctuation behind."""
    suffixes = nonblank(F.concat(text(pers_suffix), F.lit(" "), text(prof_suffix)))
    return F.concat(
        text(last),
        F.when(suffixes.isNotNull(), F.concat(F.lit(" "), suffixes)).otherwise(""),
        F.when(nonblank(first).isNotNull(), F.concat(F.lit(", "), first)).otherwise(""),
        F.when(
            nonblank(middle).isNotNull(),
            F.concat(F.lit(" "), F.substring(middle, 1, 1), F.lit(".")),
        ).otherwise(""),
    )
