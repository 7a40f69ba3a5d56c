"""Outcomes of a unit: single-unit fundraisers, stop counts, proposals in a window, qualifications."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgeline.functions.fiscal import as_date
from pledgeline.functions.values import both, flag, listed_name, one_of
from pledgeline.operators.qualifications import (
    CAMPUS,
    DISQUALIFIED,
    POSITIVE,
    StageRule,
    assignment_flags,
    proposal_facts,
    qualification_status,
    stage_facts,
)
from pledgeline.operators.roles import with_record_type
from pledgeline.plans.skew import largest_per_key, splittable_join

# a fundraiser with no active assignment elsewhere counts as having left there on this day
NEVER_ELSEWHERE = dt.date(1930, 1, 1)
PROPOSAL_COUNTS = ["stops", "cn_stop", "td_stop", "nr_stop", "other_stop", "rp_stop"]
ASSIGNMENT_COUNTS = ["starts", "portfolio"]


def _picked(unit: str, fundraisers: list[int] | None) -> Column:
    return both(F.col("office_code") == unit, one_of(F.col("assignment_entity_id"), fundraisers))


def unit_flags(
    assignment: DataFrame,
    proposal: DataFrame,
    unit: str,
    fundraisers: list[int] | None = None,
    plan_types: list[str] | None = None,
) -> DataFrame:
    """Per fundraiser: works in the unit, since when, and active elsewhere, since when.

    ``unit_exclusive`` holds for those working in the unit only.
    """
    elsewhere = both(
        F.col("office_code") != unit,
        one_of(F.col("assignment_entity_id"), fundraisers),
        F.col("active_ind") == "Y",
    )
    here = _picked(unit, fundraisers)
    wanted = both(one_of(F.col("proposal_type"), plan_types))
    return (
        assignment.join(proposal.filter(wanted).select("proposal_id"), "proposal_id", "left_semi")
        .groupBy("assignment_entity_id")
        .agg(
            F.bool_or(flag(here)).alias("_here"),
            F.max(F.when(here, F.col("start_date"))).alias("unitdt"),
            F.bool_or(flag(elsewhere)).alias("_elsewhere"),
            F.coalesce(
                F.max(F.when(elsewhere, F.col("start_date"))), F.lit(NEVER_ELSEWHERE)
            ).alias("othunitdt"),
        )
        .select(
            "assignment_entity_id",
            _yes_no(F.col("_here")).alias("flg"),
            "unitdt",
            _yes_no(F.col("_elsewhere")).alias("flg2"),
            "othunitdt",
            (
                F.col("_here") & ~F.col("_elsewhere") & flag(F.col("unitdt") > F.col("othunitdt"))
            ).alias("unit_exclusive"),
        )
    )


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


UNIT_KEYS = ["assignment_entity_id", "office_desc", "proposal_id"]


def _unit_status(
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    unit: str,
    rules: dict[str, StageRule],
    start: dt.date | str,
    end: dt.date | str,
    plan_types: list[str] | None,
) -> DataFrame:
    """Status per fundraiser, unit description and proposal; plan types do not bear on ``dq``."""
    wanted = both(one_of(F.col("proposal_type"), plan_types))
    in_unit = F.col("office_code") == unit
    return qualification_status(
        assignment.select(*UNIT_KEYS, "office_code", "start_date", "stop_date"),
        stage,
        proposal,
        UNIT_KEYS,
        rules,
        {name: None if name == "dq" else wanted for name in rules},
        start,
        end,
        included_when=in_unit,
        only=assignment.filter(in_unit).select("proposal_id").distinct(),
    )


def unit_qualified(
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    unit: str,
    start: dt.date | str,
    end: dt.date | str,
    plan_types: list[str] | None = None,
) -> DataFrame:
    """(fundraiser, unit description, proposal) that moved from QU to a positive stage."""
    rules = {"qual": POSITIVE}
    status = _unit_status(assignment, stage, proposal, unit, rules, start, end, plan_types)
    return status.filter("qual_included and not qual_excluded").select(*UNIT_KEYS)


def unit_disqualified(
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    unit: str,
    start: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    """(fundraiser, unit description, proposal) that moved from QU to DQ; any proposal type."""
    rules = {"dq": DISQUALIFIED}
    status = _unit_status(assignment, stage, proposal, unit, rules, start, end, None)
    return status.filter("dq_included and not dq_excluded").select(*UNIT_KEYS)


def unit_outcomes(
    assignment: DataFrame,
    proposal: DataFrame,
    stage: DataFrame,
    record_type: DataFrame,
    unit: str,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    fundraisers: list[int] | None = None,
    plan_types: list[str] | None = None,
) -> DataFrame:
    """Starts, stops by kind, qualifications and portfolio size of staff working only in ``unit``.

    ``starts`` and ``portfolio`` count assignments, the others proposals. ``other_stop`` is every
    stop but CN, TD, DQ and NR, so it includes ``rp_stop``; these two and ``stops`` do not require
    that nothing was granted. ``dq_stop`` ignores ``plan_types``.
    """
    first, last, now = (F.lit(as_date(d)) for d in (start, end, as_of))
    stop, code = F.col("stop_dt"), F.col("proposal_stage")
    wanted = both(one_of(F.col("proposal_type"), plan_types))
    stopped = (
        (F.col("start_date").isNull() | (F.col("start_date") <= stop))
        & (F.coalesce(F.col("stop_date"), now) >= stop)
        & stop.between(first, last)
        & wanted
    )
    nothing_granted = F.col("granted_amt") == 0
    conditions = {
        "starts": F.col("start_date").between(first, last) & wanted,
        "portfolio": (F.col("stop_date").isNull() | (F.col("stop_date") >= first))
        & (F.col("start_date") <= last)
        & wanted,
        "stops": stopped,
        "cn_stop": stopped & (code == "CN") & nothing_granted,
        "td_stop": stopped & (code == "TD") & nothing_granted,
        "nr_stop": stopped & (code == "NR") & nothing_granted,
        "other_stop": stopped & ~code.isin("CN", "TD", "DQ", "NR"),
        "rp_stop": stopped & (code == "RP"),
    }
    person = ["assignment_entity_id", "assignment_first_name", "assignment_last_name"]
    rows = (
        assignment.filter(both(_picked(unit, fundraisers), F.col("assignment_type") == "DO"))
        .select(*person, "assignment_id", "proposal_id", "start_date", "stop_date")
        .join(
            proposal.select(
                "proposal_id",
                "proposal_type",
                "stop_dt",
                "granted_amt",
                F.col("stage_code").alias("proposal_stage"),
            ),
            "proposal_id",
        )
        .select(
            *person,
            "assignment_id",
            "proposal_id",
            *[flag(condition).alias(name) for name, condition in conditions.items()],
        )
    )
    # every row counts once for its assignment and once for its proposal: two copies, flagged, instead
    # of one copy per distinct count
    unset = lambda names: [F.lit(False).alias(n) for n in names]
    as_assignment = F.struct(
        F.lit("A").alias("kind"),
        F.col("assignment_id").alias("id"),
        *ASSIGNMENT_COUNTS,
        *unset(PROPOSAL_COUNTS),
    )
    as_proposal = F.struct(
        F.lit("P").alias("kind"),
        F.col("proposal_id").alias("id"),
        *unset(ASSIGNMENT_COUNTS),
        *PROPOSAL_COUNTS,
    )
    names = ASSIGNMENT_COUNTS + PROPOSAL_COUNTS
    counted = (
        rows.select(*person, F.inline(F.array(as_assignment, as_proposal)))
        .groupBy(*person, "kind", "id")
        .agg(*[F.bool_or(n).alias(n) for n in names])
        .groupBy(*person)
        .agg(*[F.count_if(F.col(n) & F.col("id").isNotNull()).alias(n) for n in names])
    )
    # everything below is one row per fundraiser
    flags = unit_flags(assignment, proposal, unit, fundraisers, plan_types)
    rules = {"qual": POSITIVE, "dq": DISQUALIFIED}
    moved = lambda name: F.count_distinct(
        F.when(F.expr(f"{name}_included and not {name}_excluded"), F.col("proposal_id"))
    )
    moves = (
        _unit_status(assignment, stage, proposal, unit, rules, start, end, plan_types)
        .groupBy("assignment_entity_id")
        .agg(moved("qual").alias("qual_cnt"), moved("dq").alias("dq_stop"))
    )
    staff = with_record_type(record_type, ["SF"])
    return (
        counted.join(
            flags.filter("unit_exclusive").select("assignment_entity_id"),
            "assignment_entity_id",
            "left_semi",
        )
        .join(staff, "assignment_entity_id", "left_semi")
        .join(moves, "assignment_entity_id", "left")
        .select(
            *person,
            "starts",
            "stops",
            "cn_stop",
            "td_stop",
            F.coalesce("dq_stop", F.lit(0)).alias("dq_stop"),
            "nr_stop",
            "other_stop",
            "rp_stop",
            F.coalesce("qual_cnt", F.lit(0)).alias("qual_cnt"),
            "portfolio",
        )
    )


def _assigned_in_window(
    dated_assignment: DataFrame,
    unit: str,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    fundraisers: list[int] | None,
) -> DataFrame:
    first, last, now = (F.lit(as_date(d)) for d in (start, end, as_of))
    return dated_assignment.withColumn(
        "_ended", F.coalesce(F.col("assignment_end_dt"), now)
    ).filter(
        both(
            F.col("assignment_begin_dt") <= last,
            F.col("_ended") >= first,
            F.col("office_assigned_to_cd") == unit,
            one_of(F.col("assigned_to_entity_id_nbr"), fundraisers),
        )
    )


def _open_in_window(
    proposal: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    plan_types: list[str] | None,
) -> DataFrame:
    first, last, now = (F.lit(as_date(d)) for d in (start, end, as_of))
    return proposal.filter(
        both(
            F.col("start_dt") <= last,
            F.coalesce(F.col("stop_dt"), now) >= first,
            one_of(F.col("proposal_type"), plan_types),
        )
    )


def window_portfolio(
    dated_assignment: DataFrame,
    proposal: DataFrame,
    unit: str,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    fundraisers: list[int] | None = None,
    plan_types: list[str] | None = None,
) -> DataFrame:
    """Proposals of a unit open in the window with the fundraisers assigned in the window.

    Both sides are aggregated before they meet: the proposal columns do not depend on the assignment
    nor the assignment dates on the proposal. Texts are grouping keys first, so that rows are combined
    by hash before the shuffle; the largest of each is taken among the few that are left.
    """
    assigned = (
        _assigned_in_window(dated_assignment, unit, start, end, as_of, fundraisers)
        .groupBy("proposal_id", "assigned_to_entity_id_nbr")
        .agg(
            F.min("assignment_begin_dt").alias("assign_begin_dt"),
            F.max("_ended").alias("assign_end_dt"),
        )
    )
    measures = {
        "prospect_id": F.col("prospect_id"),
        "proposal_begin_dt": F.col("start_dt"),
        "target_ask": F.col("original_ask_amt"),
        "target_date": F.col("expected_date"),
        "actual_ask": F.col("ask_amt"),
        "actual_date": F.col("initial_contribution_dt"),
        "commit_amt": F.col("granted_amt"),
        "commit_dt": F.col("stop_dt"),
        "days_in_stage": F.datediff(F.lit(as_date(as_of)), F.col("proposal_stage_begin_dt")),
    }
    texts = {
        "stage": "stage_code",
        "stage_desc": "stage_desc",
        "stage_rank": "stage_rank_code",
        "proposal_title": "proposal_title",
    }
    alike = (
        _open_in_window(proposal, start, end, as_of, plan_types)
        .groupBy("proposal_id", *[F.col(c).alias(name) for name, c in texts.items()])
        .agg(*[F.max(c).alias(name) for name, c in measures.items()])
    )
    held = largest_per_key(alike, "proposal_id", [*measures, *texts])
    return splittable_join(assigned, held, ["proposal_id"]).select(
        "proposal_id",
        "assigned_to_entity_id_nbr",
        "prospect_id",
        "stage",
        "stage_desc",
        "stage_rank",
        "proposal_begin_dt",
        "proposal_title",
        "target_ask",
        "target_date",
        "actual_ask",
        "actual_date",
        "commit_amt",
        "commit_dt",
        "days_in_stage",
        "assign_begin_dt",
        "assign_end_dt",
    )


def total_qualifications(
    dated_assignment: DataFrame,
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    prospect: DataFrame,
    proposal_summary: DataFrame,
    entity_prospect_summary: DataFrame,
    unit: str,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    fundraisers: list[int] | None = None,
    plan_types: list[str] | None = None,
) -> DataFrame:
    """Qualified proposals of a unit with prospect, manager and the month of their latest move.

    Exclusion works on whole proposals: one excluded assignment of a portfolio fundraiser drops the
    proposal for all. Every input is read once (proposals for their facts, for the portfolio and for the
    description): one pass over the assignments finds the qualified proposals with their prospects and
    latest move, and that small set then meets the descriptions, before anything of them is aggregated.
    """
    first, last = as_date(start), as_date(end)
    rules, accepted = {"campus": CAMPUS}, {"campus": F.col("primary_ind") == "Y"}
    # the portfolio as two kinds of keys: the proposals that can qualify, the people who can exclude
    of = lambda person, key: F.struct(F.lit(person).alias("_person"), F.col(key).alias("_key"))
    keys = (
        _assigned_in_window(dated_assignment, unit, start, end, as_of, fundraisers)
        .select("proposal_id", "assigned_to_entity_id_nbr")
        .distinct()
        .join(
            _open_in_window(proposal, start, end, as_of, plan_types).select("proposal_id"),
            "proposal_id",
            "left_semi",
        )
        .select(F.inline(F.array(of(False, "proposal_id"), of(True, "assigned_to_entity_id_nbr"))))
        .distinct()
    )
    facts = stage_facts(stage, rules, first, last, latest=True).join(
        proposal_facts(proposal, first, accepted), "proposal_id"
    )
    flags = assignment_flags(rules, accepted, first, last, included_when=_picked(unit, fundraisers))
    asked = splittable_join(
        assignment.select(
            "assignment_entity_id",
            "office_code",
            "proposal_id",
            F.col("prospect_id").alias("assigned_prospect_id"),
            "start_date",
            "stop_date",
        ),
        facts,
        ["proposal_id"],
    ).select(
        "proposal_id",
        "assigned_prospect_id",
        F.col("campus_latest").alias("_moved"),
        flags["campus_included"].alias("_included"),
        # every assignment asks for its proposal, one that excludes for its fundraiser too
        F.inline(
            F.array(
                of(False, "proposal_id"),
                F.when(flags["campus_excluded"], of(True, "assignment_entity_id")),
            )
        ),
    )
    every = Window.partitionBy("proposal_id")
    qualified = (
        splittable_join(asked.filter(F.col("_key").isNotNull()), keys, ["_person", "_key"])
        .groupBy("proposal_id", "assigned_prospect_id", "_moved")
        .agg(
            F.bool_or(F.col("_included") & ~F.col("_person")).alias("_included"),
            F.bool_or("_person").alias("_excluded"),
        )
        # one row per prospect of a proposal
        .withColumn("_included", F.max("_included").over(every))
        .withColumn("_excluded", F.max("_excluded").over(every))
        .filter("_included and not _excluded")
        .select("proposal_id", "assigned_prospect_id", F.col("_moved").alias("stage_date"))
    )
    names = prospect.select(
        F.col("prospect_id").alias("assigned_prospect_id"),
        "prospect_name",
        F.when(F.col("prospect_entity_primary_ind") == "Y", F.col("entity_id")).alias(
            "_primary_entity"
        ),
    )
    held = proposal.filter(F.col("primary_ind") == "Y").select(
        "proposal_id", "prospect_id", "stage_desc", "stage_code", F.col("entity_id").alias("_donor")
    )
    summary = entity_prospect_summary.select(
        F.col("entity_id").alias("_donor"),
        "capacity_rating_desc",
        "primary_manager_last_nm",
        "primary_manager_first_nm",
    )
    described = [
        "prospect_id",
        "prospect_name",
        "proposal_assignments",
        "stage_desc",
        "stage_code",
        "capacity_rating_desc",
        "primary_manager_last_nm",
        "primary_manager_first_nm",
    ]
    manager = F.when(
        F.col("primary_manager_last_nm").isNotNull(),
        listed_name(F.col("primary_manager_last_nm"), F.col("primary_manager_first_nm")),
    )
    smallest = Window.partitionBy("proposal_id").orderBy("stage_date", *described, "entity_id")
    return (
        qualified.join(held, "proposal_id")
        .join(proposal_summary.select("proposal_id", "proposal_assignments"), "proposal_id")
        .join(names, "assigned_prospect_id")
        .join(summary, "_donor")
        .groupBy("proposal_id", "stage_date", *described)
        .agg(F.max("_primary_entity").alias("entity_id"))
        # one description per proposal: the smallest where there are several
        .withColumn("_place", F.row_number().over(smallest))
        .filter("_place = 1")
        .select(
            "proposal_id",
            "prospect_id",
            "prospect_name",
            "entity_id",
            F.replace("proposal_assignments", F.lit(") DO"), F.lit(")")).alias(
                "proposal_assignments"
            ),
            "stage_desc",
            "stage_code",
            "capacity_rating_desc",
            manager.alias("primary_manager_last_nm"),
            F.date_format("stage_date", "yyyy-MM").alias("dt_sort"),
            F.date_format("stage_date", "MMMM yyyy").alias("dt_disp"),
            F.lit(1).cast("long").alias("quals"),
        )
    )
