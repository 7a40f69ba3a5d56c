"""Denormalised proposals: one row per assignment, proposal, prospect and entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.functions.values import flag
from pledgeline.plans.skew import splittable_join

ASSIGNMENT_NAMES = {
    "active_ind": "assignment_active",
    "start_date": "assignment_start_dt",
    "stop_date": "assignment_stop_dt",
    "program_code": "assignment_program_code",
    "program_desc": "assignment_program_desc",
    "unit_code": "assignment_unit_code",
    "unit_desc": "assignment_unit_desc",
}
PROPOSAL_NAMES = {
    "active_ind": "proposal_active",
    "stage_code": "proposal_stage_code",
    "stage_desc": "proposal_stage_desc",
    "start_dt": "proposal_start_dt",
    "stop_dt": "proposal_stop_dt",
    "program_code": "proposal_program_code",
    "program_desc": "proposal_program_desc",
    "unit_code": "proposal_unit_code",
    "unit_desc": "proposal_unit_desc",
    "crm_id": "proposal_crm_id",
}
PROSPECT_NAMES = {
    "active_ind": "prospect_active",
    "start_date": "prospect_start_dt",
    "stop_date": "prospect_stop_dt",
    "crm_id": "prospect_crm_id",
}


def assigned_proposals(
    assignment: DataFrame, proposal: DataFrame, primary_prop_only: bool = True
) -> DataFrame:
    """``DO`` assignments with their proposals, inactive ones included.

    With ``primary_prop_only`` the rows of a proposal that differ only in entity and primary flag
    are one; not every proposal has a row marked primary.
    """
    return splittable_join(
        _do_assignments(assignment), _held_proposals(proposal, primary_prop_only), ["proposal_id"]
    )


def _do_assignments(assignment: DataFrame) -> DataFrame:
    return (
        assignment.filter((F.col("assignment_type") == "DO") & F.col("proposal_id").isNotNull())
        .withColumnsRenamed(ASSIGNMENT_NAMES)
        .drop("entity_id", "prospect_id")
    )


def _held_proposals(proposal: DataFrame, primary_prop_only: bool) -> DataFrame:
    held = proposal.withColumnsRenamed(PROPOSAL_NAMES).drop(
        "entity_id", "summary_entity_id", "primary_ind", "primary_ind_cnt"
    )
    return held.distinct() if primary_prop_only else held


def primary_entities(prospect: DataFrame, primary_entity_only: bool = True) -> DataFrame:
    """Prospects with a repaired primary flag, ``primary_entity_revised``.

    A prospect with a primary keeps its flags as they are. Without one, its only entity, or else the
    one with the lowest id, is primary. Unflagged rows of a prospect with a primary are dropped;
    with ``primary_entity_only`` so is every row that is not primary.
    """
    per_prospect = prospect.groupBy("prospect_id").agg(
        F.bool_or(flag(F.col("prospect_entity_primary_ind") == "Y")).alias("_has_primary"),
        F.count(F.lit(1)).alias("_rows"),
        F.min("entity_id").alias("_lowest"),
    )
    revised = (
        F.when(F.col("_has_primary"), F.col("prospect_entity_primary_ind"))
        .when((F.col("_rows") == 1) | (F.col("entity_id") == F.col("_lowest")), "Y")
        .otherwise("N")
    )
    kept = ["Y"] if primary_entity_only else ["Y", "N"]
    rows = prospect.filter(F.col("prospect_id").isNotNull())
    return (
        splittable_join(rows, per_prospect, ["prospect_id"])
        .withColumn("primary_entity_revised", revised)
        .filter(F.col("primary_entity_revised").isin(kept))
        .drop("_has_primary", "_rows", "_lowest")
    )


def proposal_fact(
    assignment: DataFrame,
    proposal: DataFrame,
    prospect: DataFrame,
    entity: DataFrame,
    primary_prop_only: bool = True,
    primary_entity_only: bool = True,
) -> DataFrame:
    """Assigned proposals with prospect and entity columns.

    Prospects meet their entities and proposals their prospects before the assignments, which are the
    most rows, are joined: a row as wide as the result is never shuffled or sorted.
    """
    prospects = primary_entities(
        prospect.withColumnsRenamed(PROSPECT_NAMES).drop("expected_date"), primary_entity_only
    )
    entities = entity.select(
        "entity_id",
        "report_name",
        "record_status_code",
        "spouse_entity_id",
        "capacity_rating_code",
        "capacity_rating_desc",
    )
    assigned = _do_assignments(assignment)
    held = _held_proposals(proposal, primary_prop_only).filter(F.col("proposal_id").isNotNull())
    described = prospects.join(entities, "entity_id", "left")
    keys = ["entity_id", "prospect_id", "proposal_id"]
    columns = [*keys, *[c for df in (assigned, held, prospects, entities) for c in df.columns if c not in keys]]
    return splittable_join(
        assigned, held.join(described, "prospect_id", "left"), ["proposal_id"]
    ).select(*columns)
