"""Asks, commits and contacts of portfolio fundraisers in a date window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.functions.fiscal import as_date
from pledgeline.functions.values import flag
from pledgeline.operators.roles import with_record_type
from pledgeline.plans.skew import splittable_join

FUNDRAISER_UNIT = ["assignment_entity_id", "office_code"]


def activity_window(
    portfolio: DataFrame,
    assignment: DataFrame,
    proposal: DataFrame,
    record_type: DataFrame,
    gift: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    dedupe_gifts: bool = True,
) -> DataFrame:
    """Asks and commits in the window, credited while assigned, one row per distinct combination.

    Proposals of type ``ESP`` take the amount of each matching gift as commit amount, others the
    granted amount. With ``dedupe_gifts`` two gifts of the same amount to one proposal merge into
    one row; without it, equal amounts stay apart in ``gift_copies``, the number of gifts merged.
    """
    start, end, as_of = (F.lit(as_date(d)) for d in (start, end, as_of))
    wanted = portfolio.select(*FUNDRAISER_UNIT).distinct()
    assigned = assignment.filter(
        (F.col("assignment_type") == "DO")
        & (F.col("stop_date").isNull() | (F.col("stop_date") >= start))
        & (F.col("start_date") <= end)
    ).select(*FUNDRAISER_UNIT, "proposal_id", "start_date", "stop_date")
    held = proposal.filter((F.col("primary_ind") == "Y") & (F.col("start_dt") <= end)).select(
        "proposal_id",
        "entity_id",
        "proposal_type",
        "stop_dt",
        "initial_contribution_dt",
        "ask_amt",
        "granted_amt",
    )
    stopped, asked = F.col("stop_dt"), F.col("initial_contribution_dt")
    open_or = lambda d: F.col("stop_date").isNull() | (F.col("stop_date") >= d)
    asked_in_window = flag(
        asked.between(start, end)
        & open_or(asked)
        & (F.col("start_date") <= asked)
        & (F.col("ask_amt") > 0)
    )
    committed_in_window = flag(
        (F.col("granted_amt") > 0)
        & stopped.between(start, end)
        & open_or(stopped)
        & (F.col("start_date") <= stopped)
    )
    takes_gifts = flag(
        (F.col("proposal_type") == "ESP")
        & (F.col("granted_amt") > 0)
        & (F.col("start_date") <= stopped)
        & (F.coalesce(F.col("stop_date"), as_of) >= stopped)
        & (stopped <= end)
    )
    # the facts meet first, where they lie; a semi join of people would be moved below that
    rows = splittable_join(assigned, held, ["proposal_id"]).select(
        "office_code",
        "assignment_entity_id",
        "proposal_id",
        F.when(asked_in_window, F.col("proposal_id")).alias("asks"),
        F.when(asked_in_window, F.col("ask_amt")).alias("ask_amt"),
        F.when(committed_in_window, F.col("proposal_id")).alias("commits"),
        F.when(committed_in_window & (F.col("proposal_type") != "ESP"), F.col("granted_amt")).alias(
            "_granted"
        ),
        F.col("entity_id").alias("_donor"),
        takes_gifts.alias("_takes_gifts"),
    )
    rows = rows.join(with_record_type(record_type, ["SF"]).distinct(), "assignment_entity_id")
    rows = splittable_join(rows, wanted, FUNDRAISER_UNIT)
    # equal amounts merge before the join; rows that take no gifts match none and stay single
    gifts = (
        gift.filter(
            (F.col("pledged_basis_flg") == "Y") & F.col("gift_credit_dt").between(start, end)
        )
        .groupBy(
            "proposal_id",
            F.col("donor_entity_id_nbr").alias("_donor"),
            F.col("transaction_credited_amt").alias("_gift_amt"),
        )
        .agg(F.count(F.lit(1)).alias("gift_copies"))
        .withColumn("_takes_gifts", F.lit(True))
    )
    copies = [] if dedupe_gifts else ["gift_copies"]
    return (
        rows.join(gifts, ["proposal_id", "_donor", "_takes_gifts"], "left")
        .select(
            "office_code",
            "assignment_entity_id",
            "proposal_id",
            "asks",
            "ask_amt",
            "commits",
            F.coalesce("_gift_amt", "_granted").alias("commit_amt"),
            *copies,
        )
        .distinct()
    )


def portfolio_contacts(
    activity: DataFrame,
    contact: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    repeat: bool = False,
) -> DataFrame:
    """Contacts in the window credited to or written by a fundraiser, for a unit they are active in.

    A contact matches when its credited person or author is the fundraiser and its credit unit or
    unit is the unit. One row per contact, fundraiser and unit; ``activity_rows`` is the number of
    activity rows it matches, that is how often the row occurs when each match is listed. ``repeat``
    lists each match, which grows with the product of a fundraiser's contacts and activity rows.
    """
    start, end = (F.lit(as_date(d)) for d in (start, end))
    weights = (
        activity.groupBy(*FUNDRAISER_UNIT).agg(F.count(F.lit(1)).alias("activity_rows"))
    ).filter(F.col("assignment_entity_id").isNotNull() & F.col("office_code").isNotNull())
    # the two ORs give at most four (fundraiser, unit) pairs per contact; distinct, so that a pair
    # matches once however many of the four it satisfies
    pair = lambda person, unit: F.struct(
        F.col(person).alias("assignment_entity_id"), F.col(unit).alias("office_code")
    )
    pairs = F.array_distinct(
        F.array(
            pair("contact_credit_entity_id", "contact_credit_unit_code"),
            pair("contact_credit_entity_id", "unit_code"),
            pair("author_entity_id", "contact_credit_unit_code"),
            pair("author_entity_id", "unit_code"),
        )
    )
    described = [
        "report_id",
        "contact_date",
        "contact_type",
        "contact_type_desc",
        "contact_purpose_code",
        "contact_purpose_desc",
        "contact_attitude_code",
        "contact_attitude_desc",
    ]
    candidates = (
        contact.filter(F.col("contact_date").between(start, end))
        .select(F.inline(pairs), *described)
        .filter(F.col("assignment_entity_id").isNotNull() & F.col("office_code").isNotNull())
    )
    matched = splittable_join(candidates, weights, FUNDRAISER_UNIT).select(
        "assignment_entity_id", "office_code", *described, "activity_rows"
    )
    if not repeat:
        return matched
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("activity_rows")))
    return matched.withColumn("_copy", copies).drop("_copy", "activity_rows", "office_code")
