"""Contact reports with fiscal year, households and fundraiser name; entity display names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.functions.fiscal import as_date
from pledgeline.functions.values import display_name
from pledgeline.plans.membership import bitmap, may_hold
from pledgeline.plans.skew import splittable_join


def contacts_between(
    contact: DataFrame,
    date_dim: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    fundraisers: list[int] | None = None,
) -> DataFrame:
    """Contacts in the window with their fiscal year, optionally those of some fundraisers."""
    first, last = F.lit(as_date(start)), F.lit(as_date(end))
    # one row per day of the window: small whatever the size of the contact table
    calendar = F.broadcast(
        date_dim.filter(F.col("calendar_dt").between(first, last)).select(
            F.col("calendar_dt").alias("contact_date"), "fiscal_yr"
        )
    )
    rows = contact.filter(F.col("contact_date").between(first, last))
    if fundraisers is not None:
        wanted = list(fundraisers)
        rows = rows.filter(
            F.col("author_entity_id").isin(wanted) | F.col("contact_credit_entity_id").isin(wanted)
        )
    return rows.join(calendar, "contact_date", "left")


def with_households(contacts: DataFrame, entity: DataFrame) -> DataFrame:
    """Add the households of the contacted and of the alternate entity."""
    household = lambda key, name: entity.select(
        F.col("entity_id").alias(key), F.col("hh_corp_entity_id").alias(name)
    )
    return contacts.join(
        household("contact_entity_id", "hh_corp_entity_id"), "contact_entity_id", "left"
    ).join(
        household("contact_alt_entity_id", "alt_hh_corp_entity_id"), "contact_alt_entity_id", "left"
    )


# who a contact names, and what is looked up of them
LOOKUPS = {
    "contact_entity_id": "hh_corp_entity_id",
    "contact_alt_entity_id": "hh_corp_entity_id",
    "contact_credit_entity_id": "report_name",
    "author_entity_id": "report_name",
}


def with_entities(
    contacts: DataFrame, entity: DataFrame, among: DataFrame | None = None
) -> DataFrame:
    """Add both households and the fundraiser's name: the credited person, or the author if unnamed.

    Contacts that name the same four people are one combination, which is unfolded into one narrow row
    per person. These meet the entities in one join, are folded back, and the combinations meet the
    contacts: these are shuffled once, however many people they name, and an entity that many contacts
    name has few rows, whose oversized partitions are split. ``among`` may be a cheaper table of contacts
    that includes these, to find the combinations in.
    """
    people = list(LOOKUPS)
    named = F.struct(*people)
    slots = F.array(
        *[F.struct(F.lit(k).alias("_slot"), F.col(c).alias("_key")) for k, c in enumerate(people)]
    )
    asked = (
        (contacts if among is None else among)
        .select(*people)
        .distinct()
        .select(named.alias("_named"), F.inline(slots))
        .filter(F.col("_key").isNotNull())
    )
    # a task holds its share of the entities, not of the many times that they are named: those stream past
    found = splittable_join(
        asked,
        entity.select(F.col("entity_id").alias("_key"), "hh_corp_entity_id", "report_name").hint(
            "shuffle_hash"
        ),
        ["_key"],
    )
    of = lambda k, column: F.max(F.when(F.col("_slot") == k, F.col(column)))
    # sorted by combination, as the join with the contacts needs it; a combination has one row per person,
    # in as many places, so combining before the shuffle would only sort all of them once more
    folded = found.repartition("_named").groupBy("_named").agg(
        *[of(k, column).alias(f"_{k}") for k, column in enumerate(LOOKUPS.values())]
    )
    return (
        splittable_join(contacts.withColumn("_named", named), folded, ["_named"], "left")
        .withColumn("hh_corp_entity_id", F.col("_0"))
        .withColumn("alt_hh_corp_entity_id", F.col("_1"))
        .withColumn("fundraiser_name", F.coalesce("_2", "_3"))
        .drop("_named", *[f"_{k}" for k in range(len(LOOKUPS))])
    )


def contacts_enriched(
    contact: DataFrame,
    entity: DataFrame,
    date_dim: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    fundraisers: list[int] | None = None,
) -> DataFrame:
    """Contacts in the window with fiscal year, both households and fundraiser name."""
    return with_entities(contacts_between(contact, date_dim, start, end, fundraisers), entity)


ROLE_KEYS = {"contact_credit_entity_id": "_credit", "author_entity_id": "_author"}


def possibly_in_role(contacts: DataFrame, roles: DataFrame) -> DataFrame:
    """The contacts that a bitmap of the role's people lets through: all in the role, few others."""
    words = bitmap(roles.select("fundraiser_entity_id"))
    possible = F.lit(False)
    for key in ROLE_KEYS:
        possible = possible | may_hold(words, F.col(key))
    return contacts.filter(possible)


def contacts_in_role(contacts: DataFrame, roles: DataFrame) -> DataFrame:
    """Contacts whose credited person or author is in ``roles``, each contact once.

    A bitmap of the role's people drops nearly all other contacts where they are read; what is left is
    checked by joins.
    """
    people = roles.select("fundraiser_entity_id").distinct()
    rows = possibly_in_role(contacts, roles)
    for key, mark in ROLE_KEYS.items():
        marked = people.select(F.col("fundraiser_entity_id").alias(key), F.lit(True).alias(mark))
        rows = splittable_join(rows, marked, [key], "left")
    return rows.filter(F.col("_credit") | F.col("_author")).select(*contacts.columns)


def entity_display_name(entity: DataFrame) -> DataFrame:
    """``Last Suffixes, First M.`` for every entity."""
    return entity.select(
        "entity_id",
        display_name(
            F.col("last_name"),
            F.col("first_name"),
            F.col("middle_name"),
            F.col("pers_suffix"),
            F.col("prof_suffix"),
        ).alias("fundraiser_name"),
    )
