"""Qualifications: proposals that left stage QU in a window while assigned, minus the exclusions.

Inclusion and exclusion are conditions on the same assignment, so one pass decides both. Stage
events are first reduced to one row per proposal: first QU date, first and last exit date, and the days
of the window with a move as bits of longs. Proposals likewise. Each assignment meets that single row,
and a group is kept if any of its assignments includes it and none excludes it. That gives the same set
as subtracting one query from the other, without joining events to events or events to assignments.
Every measure of a proposal has a fixed width, so stage events are combined before the shuffle by hash.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeline.functions.fiscal import add_months_eom, as_date
from pledgeline.functions.values import both, flag, one_of
from pledgeline.plans.skew import splittable_join


@dataclass(frozen=True)
class StageRule:
    """Stages that qualify a proposal, and stages that exclude it when reached too early or late."""

    include: tuple[str, ...]
    exclude: tuple[str, ...]


# Stage codes
CAMPUS = StageRule(
    include=("PD", "SP", "GS", "DS", "CU", "RP", "DQ", "TD"),
    exclude=("PD", "SP", "GS", "DS", "CU", "CN", "RP", "DQ", "TD"),
)
POSITIVE = StageRule(
    include=("PD", "SP", "GS", "DS", "CU"),
    exclude=("PD", "SP", "GS", "DS", "CU"),
)
DISQUALIFIED = StageRule(include=("DQ",), exclude=("DQ",))


#: Days per word of a day bitmap.
WORD = 64


def _words(start: dt.date, end: dt.date) -> int:
    return max(1, -(-((end - start).days + 1) // WORD))


def _day_bits(wanted: Column, day: Column, start: dt.date, word: int) -> Column:
    """One word of the bitmap of the days (from ``start`` on) of the rows that are wanted."""
    offset = F.datediff(day, F.lit(start))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(offset, F.lit(WORD)))
    inside = wanted & offset.between(word * WORD, word * WORD + WORD - 1)
    return F.bit_or(F.when(inside, bit).otherwise(F.lit(0).cast("long")))


def any_day_between(words: list[Column], start: dt.date, first: Column, last: Column) -> Column:
    """Whether a bitmap of days has one from ``first`` to ``last``, both known."""
    found = F.lit(False)
    ones = F.lit(-1).cast("long")
    for k, word in enumerate(words):
        low = F.greatest(F.datediff(first, F.lit(start)) - k * WORD, F.lit(0))
        high = F.least(F.datediff(last, F.lit(start)) - k * WORD, F.lit(WORD - 1))
        mask = F.call_function("shiftleft", ones, low).bitwiseAND(
            F.call_function("shiftrightunsigned", ones, WORD - 1 - high)
        )
        found = found | ((low <= high) & (word.bitwiseAND(mask) != 0))
    return found


# stage ids are any longs: with the day of the window they make one number that has their order
_ID_STEP = 1 << 20


def latest_day(stage_id: Column, day: Column, start: dt.date) -> Column:
    """An aggregate that keeps the day of the row with the largest id (missing ones first), then day."""
    missing = F.lit(str(-(1 << 63) - 1)).cast("decimal(19,0)")
    number = F.coalesce(stage_id.cast("decimal(19,0)"), missing)
    packed = number * F.lit(_ID_STEP) + F.datediff(day, F.lit(start))
    return F.max(packed.cast("decimal(38,0)"))


def unpacked_day(packed: Column, start: dt.date) -> Column:
    return F.date_add(F.lit(start), F.pmod(packed, F.lit(_ID_STEP)).cast("int"))


def stage_facts(
    stage: DataFrame,
    rules: dict[str, StageRule],
    start: dt.date,
    end: dt.date,
    latest: bool = False,
) -> DataFrame:
    """One row per proposal that was in QU by the end of the window, for all rules at once.

    ``<rule>_days_<k>`` hold the days of the window with an including stage as bits;
    ``<rule>_first_exit`` and ``<rule>_last_exit`` the first and last day with an excluding stage. With
    ``latest``, ``<rule>_latest`` is the day of the last such move by stage id.
    """
    code, day = F.col("stage_code"), F.col("day")
    in_qu = flag((code == "QU") & (day <= F.lit(end)))
    wanted, measures = in_qu, [F.min(F.when(in_qu, day)).alias("first_qu")]
    for name, rule in rules.items():
        exits = flag(code.isin(list(rule.exclude)))
        moves = flag(code.isin(list(rule.include)) & day.between(F.lit(start), F.lit(end)))
        wanted = wanted | exits | moves
        measures += [
            F.min(F.when(exits, day)).alias(name + "_first_exit"),
            F.max(F.when(exits, day)).alias(name + "_last_exit"),
            *[
                _day_bits(moves, day, start, k).alias(f"{name}_days_{k}")
                for k in range(_words(start, end))
            ],
        ]
        if latest:
            number = F.when(moves, F.col("proposal_stage_id"))
            measures.append(
                latest_day(number, F.when(moves, day), start).alias(name + "_latest")
            )
    facts = (
        stage.withColumn("day", F.to_date("stage_date"))
        .filter(wanted)
        .groupBy("proposal_id")
        .agg(*measures)
        .filter(F.col("first_qu").isNotNull())
    )
    if latest:
        facts = facts.withColumns(
            {f"{name}_latest": unpacked_day(F.col(f"{name}_latest"), start) for name in rules}
        )
    return facts


def proposal_facts(
    proposal: DataFrame, start: dt.date, accepted: dict[str, Column | None]
) -> DataFrame:
    """One row per proposal: ended before the window or in QU, and accepted for each rule."""
    before = F.lit(start)
    stopped = F.col("stop_dt") < before
    died = (
        (F.col("stage_code") == "QU")
        & (F.col("active_ind") != "Y")
        & (
            stopped
            | (F.col("stop_dt").isNull() & (add_months_eom(F.col("expected_date"), 6) < before))
        )
    )
    return proposal.groupBy("proposal_id").agg(
        F.bool_or(flag(stopped) | flag(died)).alias("ended"),
        *[
            F.bool_or(flag(condition)).alias(name + "_accepted")
            for name, condition in accepted.items()
            if condition is not None
        ],
    )


def assignment_flags(
    rules: dict[str, StageRule],
    accepted: dict[str, Column | None],
    start: dt.date,
    end: dt.date,
    included_when: Column | None = None,
    excluded_when: Column | None = None,
) -> dict[str, Column]:
    """``<rule>_included`` and ``<rule>_excluded`` of an assignment that met its proposal's facts."""
    flags = {}
    for name in rules:
        days = [F.col(f"{name}_days_{k}") for k in range(_words(start, end))]
        after_qu = F.greatest(F.col("start_date"), F.date_add("first_qu", 1))
        until = F.least(F.coalesce(F.col("stop_date"), F.lit(end)), F.lit(end))
        included = F.col("start_date").isNotNull() & any_day_between(days, start, after_qu, until)
        if accepted[name] is not None:
            included = included & flag(F.col(name + "_accepted"))
        if included_when is not None:
            included = included & flag(included_when)
        first_exit, last_exit = F.col(name + "_first_exit"), F.col(name + "_last_exit")
        outside = (
            flag(first_exit < F.lit(start))
            | flag(F.col("start_date") > first_exit)
            | flag(F.col("stop_date") < last_exit)
        )
        # "ended" is missing where there is no such proposal, and then nothing excludes
        excluded = F.col("ended").isNotNull() & (outside | flag(F.col("ended")))
        if excluded_when is not None:
            excluded = excluded & flag(excluded_when)
        flags |= {name + "_included": included, name + "_excluded": excluded}
    return flags


def qualification_status(
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    keys: list[str],
    rules: dict[str, StageRule],
    accepted: dict[str, Column | None],
    start: dt.date | str,
    end: dt.date | str,
    included_when: Column | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """``<rule>_included`` and ``<rule>_excluded`` per group of ``keys``.

    ``included_when`` is a condition on the assignment. ``accepted`` gives for each rule a condition on
    the proposal, for inclusion only; with ``None`` inclusion does not look at proposals at all.
    ``only`` limits the result to some distinct ``proposal_id``s: give it where no other proposal can be
    included and exclusions alone do not matter.
    """
    start, end = as_date(start), as_date(end)
    facts = stage_facts(stage, rules, start, end)
    if only is not None:
        # the facts lie by proposal already, with all events combined
        facts = facts.join(only, "proposal_id", "left_semi")
    facts = facts.join(proposal_facts(proposal, start, accepted), "proposal_id", "left")
    flags = assignment_flags(rules, accepted, start, end, included_when)
    return (
        splittable_join(assignment, facts, ["proposal_id"])
        .select(*keys, *[condition.alias(name) for name, condition in flags.items()])
        .filter(" or ".join(flags))
        .groupBy(*keys)
        .agg(*[F.bool_or(name).alias(name) for name in flags])
    )


def _campus_status(
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    offices: list[str] | None,
    plan_types: list[str] | None,
) -> DataFrame:
    """Status per fundraiser and proposal, whether or not in a portfolio."""
    return qualification_status(
        assignment.select(
            "assignment_entity_id", "office_code", "proposal_id", "start_date", "stop_date"
        ),
        stage,
        proposal,
        ["assignment_entity_id", "proposal_id"],
        {"campus": CAMPUS},
        {"campus": both(one_of(F.col("proposal_type"), plan_types))},
        start,
        end,
        included_when=one_of(F.col("office_code"), offices),
    )


def _by_unit(found: DataFrame, portfolio: DataFrame) -> DataFrame:
    """What was found, once for each unit that the fundraiser has in the portfolio."""
    units = portfolio.select("assignment_entity_id", "office_code").distinct()
    return splittable_join(
        found.select("assignment_entity_id", "proposal_id"), units, ["assignment_entity_id"]
    ).select("assignment_entity_id", "office_code", "proposal_id")


def qualifications(
    portfolio: DataFrame,
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    offices: list[str] | None = None,
    plan_types: list[str] | None = None,
) -> DataFrame:
    """Qualified (fundraiser, unit, proposal): left QU in the window while assigned, not excluded.

    Assignments are matched to the portfolio by fundraiser only. ``offices`` tests the unit of the
    assignment while the result carries the unit of the portfolio; both filters bear on inclusion
    only.
    """
    status = _campus_status(assignment, stage, proposal, start, end, offices, plan_types)
    return _by_unit(status.filter("campus_included and not campus_excluded"), portfolio)


def qualification_exclusions(
    portfolio: DataFrame,
    assignment: DataFrame,
    stage: DataFrame,
    proposal: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    """The (fundraiser, unit, proposal) that qualifications leave out, to explain missing ones.

    Excluded are proposals once in QU that reached a later stage before the window or outside the
    assignment, stopped before the window whatever their stages, or died in QU.
    """
    status = _campus_status(assignment, stage, proposal, start, end, None, None)
    return _by_unit(status.filter("campus_excluded"), portfolio)


def qualification_counts(qualified: DataFrame) -> DataFrame:
    """Number of qualified proposals per fundraiser and unit."""
    return qualified.groupBy("assignment_entity_id", "office_code").agg(
        F.count_distinct("proposal_id").alias("qual_cnt")
    )
