"""Fundraiser goals, roles and record types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.functions.values import both, one_of


def fundraisers_in_role(goal: DataFrame, fiscal_year: int, roles: list[str] | None = None) -> DataFrame:
    """Distinct fundraisers with a goal in the fiscal year, optionally only in some roles."""
    return (
        goal.filter(both(F.col("fiscal_year") == fiscal_year, one_of(F.col("fundraiser_role"), roles)))
        .select(F.col("entity_id").alias("fundraiser_entity_id"))
        .distinct()
    )


def current_role(goal: DataFrame, fiscal_year: int) -> DataFrame:
    """One role per fundraiser: active descending, then latest created, missing values first.

    The greatest goal per key is an aggregate, so it is combined before the shuffle; a window would
    bring every goal of a fundraiser to one task.
    """
    rank = F.struct(
        F.col("active").isNull().alias("no_active"),
        F.col("active"),
        F.col("created_date").isNull().alias("no_created"),
        F.col("created_date"),
        F.col("fundraiser_role"),
    )
    return (
        goal.filter(F.col("fiscal_year") == fiscal_year)
        .groupBy("entity_id", "fiscal_year")
        .agg(F.max(rank).alias("_top"))
        .select("entity_id", F.col("_top.fundraiser_role").alias("fundraiser_role"), "fiscal_year")
    )


def with_record_type(record_type: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Fundraisers having a record type (any, or one of ``codes``), for use in a semi-join."""
    wanted = one_of(F.col("record_type_code"), codes)
    rows = record_type if wanted is None else record_type.filter(wanted)
    return rows.select(F.col("entity_id").alias("assignment_entity_id"))
