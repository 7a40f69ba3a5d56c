"""Lookups of the people that contacts name."""

import random

import pytest
from conftest import rows

from pledgeline.operators.contacts import LOOKUPS, contacts_enriched, with_entities


def _made(table, hot):
    """Contacts of a few donors; half of them name one donor and one author."""
    draw = random.Random(6)
    entities = [
        dict(entity_id=i, hh_corp_entity_id=draw.choice([None, i // 2]),
             report_name=draw.choice([None, f"N{i}", f"N{i}"])) for i in range(40)
    ]
    anyone = lambda: draw.choice([None, *range(45)])
    contacts = []
    for i in range(500):
        people = {c: anyone() for c in LOOKUPS}
        if draw.random() < hot:
            people |= {"contact_entity_id": 7, "author_entity_id": 3}
        # reports may repeat
        contacts.append(dict(report_id=i % 450, contact_date="2021-08-01", **people))
    return entities, contacts


@pytest.mark.parametrize("hot", [0, 0.5, 1])
def test_against_lookups_one_by_one(spark, table, hot):
    entities, contacts = _made(table, hot)
    by_id = {e["entity_id"]: e for e in entities}
    of = lambda i, c: by_id.get(i, {}).get(c)
    expected = sorted(
        (
            (c["report_id"], *[c[k] for k in LOOKUPS], of(c["contact_entity_id"], "hh_corp_entity_id"),
             of(c["contact_alt_entity_id"], "hh_corp_entity_id"),
             of(c["contact_credit_entity_id"], "report_name") or of(c["author_entity_id"], "report_name"))
            for c in contacts
        ),
        key=repr,
    )
    df = with_entities(table("contact", contacts), table("entity", entities))
    assert rows(df, "report_id", *LOOKUPS, "hh_corp_entity_id", "alt_hh_corp_entity_id",
                "fundraiser_name") == expected


def test_without_rows(spark, table):
    days = table("date_dim", [dict(calendar_dt="2021-08-01", fiscal_yr=2022)])
    made = contacts_enriched(table("contact", []), table("entity", []), days, "2021-07-01", "2022-06-30")
    assert made.columns[-3:] == ["hh_corp_entity_id", "alt_hh_corp_entity_id", "fundraiser_name"]
    assert made.count() == 0
