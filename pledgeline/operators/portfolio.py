"""Active portfolio, planned asks and actual asks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeline.functions.values import both, flag, listed_name, one_of
from pledgeline.operators.roles import current_role, with_record_type
from pledgeline.plans.skew import number_rows, splittable_join

# what each row number counts within
ROW_NUMBER_KEYS = {
    "rn2": ["prospect_id", "office_code"],
    "rn3": ["proposal_id", "office_code"],
    "rn4": ["proposal_id", "office_code", "assignment_entity_id"],
}


def active_portfolio(
    proposal: DataFrame,
    assignment: DataFrame,
    record_type: DataFrame,
    goal: DataFrame,
    role_fy: int,
    offices: list[str] | None = None,
    fundraisers: list[int] | None = None,
    roles: list[str] | None = None,
    plan_types: list[str] | None = None,
    record_types: list[str] | None = None,
    row_numbers: tuple[str, ...] = ("rn2", "rn3", "rn4"),
) -> DataFrame:
    """Active primary proposals with their active ``DO`` assignments; ``None`` means no filter.

    A fundraiser must have a record type (one of ``record_types`` if given); several record types do
    not repeat the row. ``row_numbers`` chooses the numbering columns: leave out those not needed,
    each costs an exchange. Their order is ``assignment_id``, so ``rn3 = 1`` is the first assignment
    of the unit to the proposal. ``assignment_id`` identifies a row.
    """
    assigned = assignment.filter(
        both(
            F.col("active_ind") == "Y",
            F.col("assignment_type") == "DO",
            one_of(F.col("assignment_entity_id"), fundraisers),
            one_of(F.col("office_code"), offices),
        )
    ).select(
        "assignment_id",
        "assignment_entity_id",
        listed_name(F.col("assignment_last_name"), F.col("assignment_first_name")).alias(
            "assignment_name"
        ),
        "office_code",
        "office_desc",
        "proposal_id",
    )
    held = proposal.filter(
        both(
            F.col("active_ind") == "Y",
            F.col("primary_ind") == "Y",
            one_of(F.col("proposal_type"), plan_types),
        )
    ).select(
        "proposal_id",
        "entity_id",
        "prospect_id",
        "primary_ind",
        "stop_dt",
        "stage_code",
        "initial_contribution_dt",
        "expected_date",
        "ask_amt",
        "original_ask_amt",
    )
    # the facts meet first, where they lie; tables of people come after, as inner joins of distinct
    # people, since a semi join would be moved below the join of the facts
    rows = splittable_join(assigned, held, ["proposal_id"])
    staff = with_record_type(record_type, record_types).distinct()
    rows = rows.join(staff, "assignment_entity_id")
    if roles is not None:
        in_role = (
            current_role(goal, role_fy)
            .filter(F.col("fundraiser_role").isin(list(roles)))
            .select(F.col("entity_id").alias("assignment_entity_id"))
        )
        rows = splittable_join(rows, in_role, ["assignment_entity_id"])
    numberings = {name: ROW_NUMBER_KEYS[name] for name in row_numbers}
    return number_rows(rows, numberings, "assignment_id", ["entity_id"])


def _is_planned():
    return (
        F.col("expected_date").isNotNull()
        & (F.col("ask_amt") == 0)
        & (F.col("original_ask_amt") > 0)
        & F.col("stop_dt").isNull()
    )


# one more than the largest id, which stands for a missing one
_AFTER_IDS = 1 << 63


def _row_order() -> Column:
    """``assignment_id``, then ``entity_id``, missing ones last, as one number (ids are not negative)."""
    number = lambda c: F.coalesce(
        F.col(c).cast("decimal(20,0)"), F.lit(str(_AFTER_IDS)).cast("decimal(20,0)")
    )
    step = F.lit(str(_AFTER_IDS + 1)).cast("decimal(20,0)")
    return (number("assignment_id") * step + number("entity_id")).cast("decimal(38,0)")


def planned_asks_by_fundraiser(portfolio: DataFrame) -> DataFrame:
    """Planned asks per fundraiser and unit, plus the part the unit counts through each of them.

    A unit counts a shared proposal once, through its first assignment (``rn3 = 1``). What is read of
    that row is kept by the least row number while rows are combined, all of fixed width, so that no
    row is sorted; its name goes along as a hash, which tells the names of one person apart.
    """
    totals = portfolio.groupBy("assignment_entity_id", "assignment_name", "office_code").agg(
        F.coalesce(F.sum(F.when(_is_planned(), F.col("original_ask_amt"))), F.lit(0)).alias(
            "total_target_ask"
        ),
        F.count_distinct(F.when(_is_planned(), F.col("proposal_id"))).alias("total_target_ask_cnt"),
    )
    first = {
        "_owner": F.col("assignment_entity_id"),
        "_owner_name": F.xxhash64("assignment_name"),
        "_amount": F.col("original_ask_amt"),
        "_planned": flag(_is_planned()),
    }
    owned = (
        portfolio.withColumns({**first, "_order": _row_order()})
        .groupBy("proposal_id", F.col("office_code").alias("_office"))
        .agg(*[F.min_by(name, "_order").alias(name) for name in first])
        .filter("_planned")
        .groupBy("_owner", "_owner_name", "_office")
        .agg(
            F.count(F.lit(1)).alias("unit_target_ask_cnt"),
            F.sum("_amount").alias("unit_target_ask"),
        )
    )
    same = (
        F.col("assignment_entity_id").eqNullSafe(F.col("_owner"))
        & (F.xxhash64("assignment_name") == F.col("_owner_name"))
        & F.col("office_code").eqNullSafe(F.col("_office"))
    )
    return totals.join(owned, same, "left").select(
        "assignment_entity_id",
        "assignment_name",
        "office_code",
        "total_target_ask",
        "total_target_ask_cnt",
        F.coalesce("unit_target_ask_cnt", F.lit(0)).alias("unit_target_ask_cnt"),
        "unit_target_ask",
    )


def planned_ask_rows(portfolio: DataFrame) -> DataFrame:
    """The portfolio rows behind the planned asks."""
    return portfolio.filter(_is_planned()).withColumns(
        {
            "target_ask": F.col("original_ask_amt"),
            "target_ask_without_actual": F.col("proposal_id"),
        }
    )


def planned_asks_by_unit(portfolio: DataFrame) -> DataFrame:
    """Planned asks per unit, each shared proposal counted once; NULL for a unit with none."""
    return (
        planned_asks_by_fundraiser(portfolio)
        .groupBy("office_code")
        .agg(F.sum("unit_target_ask").alias("unit_target_ask"))
    )


def actual_asks(portfolio: DataFrame) -> DataFrame:
    """Portfolio rows (with ``rn3``) whose ask was made and is still open."""
    made = (
        F.col("initial_contribution_dt").isNotNull()
        & (F.col("ask_amt") > 0)
        & F.col("stop_dt").isNull()
        & (F.col("primary_ind") == "Y")
    )
    # rn3 is unique per proposal and unit, so every row is a group of its own
    return portfolio.filter(made).select(
        "assignment_entity_id",
        "assignment_name",
        "office_code",
        "proposal_id",
        F.col("ask_amt").alias("actual_ask"),
        F.lit(1).cast("long").alias("actual_ask_cnt"),
        "rn3",
    )
