"""The fundraiser dashboard: scoped inputs, all trends as one table, bar numbers and captions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pledgeline.functions.fiscal import as_date, is_ytd
from pledgeline.functions.values import both, one_of
from pledgeline.operators.contacts import (
    contacts_between,
    contacts_in_role,
    possibly_in_role,
    with_entities,
    with_households,
)
from pledgeline.operators.history import first_forward_moves
from pledgeline.operators.proposals import assigned_proposals, proposal_fact
from pledgeline.operators.roles import fundraisers_in_role
from pledgeline.operators.trends import (
    AMOUNT,
    VISIT_TYPES,
    proposal_totals,
    qualification_totals,
    trend_columns,
)
from pledgeline.plans.skew import splittable_join

SECTIONS = [
    "visits",
    "unique_v",
    "sig_contacts",
    "qualifications",
    "asks_n",
    "asks_total",
    "commits_n",
    "commits_total",
]

# the columns of assignments and proposals that the trends read or may be grouped by
TREND_ASSIGNMENT = ["assignment_entity_id", "unit_code", "unit_desc"]
TREND_PROPOSAL = [
    "proposal_id",
    "proposal_type",
    "initial_contribution_dt",
    "ask_amt",
    "stop_dt",
    "granted_amt",
]


def scoped_contacts(
    tables: Mapping[str, DataFrame],
    in_role: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    units: list[str] | None = None,
    fundraisers: list[int] | None = None,
    lean: bool = False,
) -> DataFrame:
    """Enriched contacts credited to or written by fundraisers in the role."""
    contacts = contacts_between(tables["contact"], tables["date_dim"], start, end, fundraisers)
    if units is not None:
        contacts = contacts.filter(F.col("unit_desc").isin(list(units)))
    in_scope = contacts_in_role(contacts, in_role)
    if lean:
        return with_households(in_scope, tables["entity"])
    return with_entities(in_scope, tables["entity"], among=possibly_in_role(contacts, in_role))


def scoped_assignments(
    tables: Mapping[str, DataFrame],
    in_role: DataFrame,
    units: list[str] | None = None,
    fundraisers: list[int] | None = None,
) -> DataFrame:
    """``DO`` assignments of fundraisers in the role."""
    assignment = tables["assignment"].filter(
        both(
            F.col("assignment_type") == "DO",
            one_of(F.col("unit_desc"), units),
            one_of(F.col("assignment_entity_id"), fundraisers),
        )
    )
    wanted = in_role.withColumnRenamed("fundraiser_entity_id", "assignment_entity_id")
    return splittable_join(assignment, wanted, ["assignment_entity_id"], "left_semi")


def scoped_proposals(
    tables: Mapping[str, DataFrame],
    in_role: DataFrame,
    units: list[str] | None = None,
    fundraisers: list[int] | None = None,
    lean: bool = False,
) -> DataFrame:
    """Denormalised proposals of fundraisers in the role."""
    assignment = scoped_assignments(tables, in_role, units, fundraisers)
    if lean:
        # what the trends read, before rows that are equal in that are made one
        assignment = assignment.select(*TREND_ASSIGNMENT, "assignment_type", "proposal_id")
        return assigned_proposals(assignment, tables["proposal"].select(*TREND_PROPOSAL))
    return proposal_fact(assignment, tables["proposal"], tables["prospect"], tables["entity"])


def scoped_qualifications(
    tables: Mapping[str, DataFrame],
    in_role: DataFrame,
    as_of: dt.date | str,
    units: list[str] | None = None,
    fundraisers: list[int] | None = None,
) -> DataFrame:
    """First forward moves of the scoped proposals."""
    # every scoped assignment of an existing proposal is a scoped proposal
    proposals = (
        scoped_assignments(tables, in_role, units, fundraisers)
        .select("proposal_id")
        .distinct()
        .join(tables["proposal"].select("proposal_id").distinct(), "proposal_id", "left_semi")
    )
    moves = first_forward_moves(tables["stage_history"], as_date(as_of))
    return moves.join(proposals, "proposal_id", "left_semi")


def scoped_inputs(
    tables: Mapping[str, DataFrame],
    start: dt.date | str,
    end: dt.date | str,
    role_fy: int,
    as_of: dt.date | str,
    roles: list[str] | None = None,
    units: list[str] | None = None,
    fundraisers: list[int] | None = None,
    lean: bool = False,
) -> dict[str, DataFrame]:
    """Roles, contacts, proposals and qualifications of the fundraisers in a role.

    ``tables`` holds the model tables by name, ``units`` are unit descriptions. Contacts and
    assignments are reduced to the fundraisers before anything is joined to them. ``lean`` leaves
    out what no trend reads: fundraiser names, prospects and entities.
    """
    in_role = fundraisers_in_role(tables["goal"], role_fy, roles)
    return {
        "role_data": in_role,
        "contact_data": scoped_contacts(tables, in_role, start, end, units, fundraisers, lean),
        "proposal_data": scoped_proposals(tables, in_role, units, fundraisers, lean),
        "qual_data": scoped_qualifications(tables, in_role, as_of, units, fundraisers),
    }


def _contact_totals(
    contacts: DataFrame, as_of: dt.date, first_fy: int, by: list[str]
) -> DataFrame:
    """Totals of the three contact sections from one pass over the contacts."""
    visit = F.col("contact_type").isin(VISIT_TYPES)
    significant = F.col("contact_attitude_code") == "Y"
    entry = lambda wanted, section, id_column: F.when(
        wanted, F.struct(F.lit(section).alias("section"), F.col(id_column).alias("id"))
    )
    own, alternate = F.col("hh_corp_entity_id"), F.col("alt_hh_corp_entity_id")
    entries = F.array(
        entry(visit, "visits", "report_id"),
        entry(visit & own.isNotNull(), "unique_v", "hh_corp_entity_id"),
        entry(visit & alternate.isNotNull(), "unique_v", "alt_hh_corp_entity_id"),
        entry(significant, "sig_contacts", "report_id"),
    )
    return (
        contacts.filter((F.col("fiscal_yr") >= first_fy) & (visit | significant))
        .select(
            *by, "fiscal_yr", is_ytd(F.col("contact_date"), as_of).alias("isytd"), F.inline(entries)
        )
        .filter(F.col("section").isNotNull())
        .groupBy(*by, "section", "fiscal_yr", "id")
        .agg(F.max("isytd").alias("isytd"))
        .groupBy(*by, "section", "fiscal_yr")
        .agg(
            F.count("id").cast(AMOUNT).alias("total"),
            F.count(F.when(F.col("isytd"), F.col("id"))).cast(AMOUNT).alias("ytd"),
        )
    )


def dashboard_long(
    contacts: DataFrame,
    proposals: DataFrame,
    qualified: DataFrame,
    as_of: dt.date | str,
    start_fy: int = 2015,
    roles: DataFrame | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """All eight sections as one table: ``section`` and the columns of a trend.

    Contacts are read once for three sections and proposals once for four. ``roles`` is needed only
    for contacts that are not scoped yet. ``by`` columns must be present in all three inputs.
    """
    as_of, by = as_date(as_of), by or []
    if roles is not None:
        contacts = contacts_in_role(contacts, roles)
    section = lambda suffix, total, ytd: F.struct(
        F.concat("metric", F.lit(suffix)).alias("section"),
        F.col(total).cast(AMOUNT).alias("total"),
        F.col(ytd).cast(AMOUNT).alias("ytd"),
    )
    columns = [*by, "section", "fiscal_yr", "total", "ytd"]
    asks_and_commits = (
        proposal_totals(proposals, ["asks", "commits"], as_of, start_fy, by)
        .select(
            *by,
            "fiscal_yr",
            F.inline(F.array(section("_n", "n", "n_ytd"), section("_total", "amt", "amt_ytd"))),
        )
        .select(*columns)
    )
    qualifications = qualification_totals(qualified, as_of, start_fy, by).select(
        *by,
        F.lit("qualifications").alias("section"),
        "fiscal_yr",
        F.col("total").cast(AMOUNT).alias("total"),
        F.col("ytd").cast(AMOUNT).alias("ytd"),
    )
    totals = (
        _contact_totals(contacts, as_of, start_fy, by)
        .select(*columns)
        .unionByName(qualifications)
        .unionByName(asks_and_commits)
    )
    return trend_columns(totals, [*by, "section"])


def dashboard_bars(long: DataFrame, years: list[int], by: list[str] | None = None) -> DataFrame:
    """One row per section, one column per fiscal year holding its total."""
    return long.groupBy(*(by or []), "section").pivot("fiscal_yr", years).agg(F.first("total"))


def captions(
    long: DataFrame, ytd: bool = False, group: list[str] | None = None
) -> DataFrame:
    """Caption numbers of the last fiscal year of each group, as (type, val).

    ``this_yr`` is the full year even with ``ytd``, which bears on the comparisons. Changes are
    relative (0.05 is 5 % up); NULL where there is no earlier year.
    """
    group = ["section"] if group is None else group
    years = Window.partitionBy(*(group or [F.lit(1)])).orderBy("fiscal_yr")
    latest = Window.partitionBy(*(group or [F.lit(1)])).orderBy(F.col("fiscal_yr").desc())
    prefix, value = ("ytd_", "ytd") if ytd else ("", "total")
    wide = (
        long.withColumn("_prev", F.lag(value).over(years))
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") == 1)
        .select(
            *group,
            F.col("total").cast("double").alias("this_yr"),
            (F.col(prefix + "vs_last_yr") - 1).alias("pct_vs_prev"),
            F.col("_prev").cast("double").alias("prev_yr"),
            (F.col(prefix + "vs_three_yr_avg") - 1).alias("pct_vs_three_yr"),
            F.col(prefix + "three_yr_avg").alias("three_yr"),
        )
    )
    kinds = ["this_yr", "pct_vs_prev", "prev_yr", "pct_vs_three_yr", "three_yr"]
    return wide.unpivot(group, kinds, "type", "val")


def dashboard_captions(long: DataFrame, ytd: bool = True, by: list[str] | None = None) -> DataFrame:
    """Captions of every section."""
    return captions(long, ytd, [*(by or []), "section"])
