import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_portfolio import assigned, held

from pledgeline.operators.activity import activity_window, portfolio_contacts
from pledgeline.operators.contacts import contacts_enriched, contacts_in_role

START, END, AS_OF = "2021-07-01", "2022-06-30", "2022-12-31"


@pytest.fixture
def run(table, spark):
    def make(assignments, proposals, gifts=(), staff=(1, 2), keys=((1, "A"), (1, "A"), (2, "A")),
             **options):
        return activity_window(
            spark.createDataFrame(list(keys), "assignment_entity_id long, office_code string"),
            table("assignment", assignments),
            table("proposal", proposals),
            table("record_type", [dict(entity_id=p, record_type_code="SF") for p in staff]
                  + [dict(entity_id=3, record_type_code="AL")]),
            table("gift", list(gifts)),
            START, END, AS_OF, **options,
        )

    return make


def test_credit_only_while_assigned(run):
    asked = dict(ask_amt=9, initial_contribution_dt="2021-09-01")
    proposals = [held(i, **asked) for i in (1, 2, 3, 4)]
    assignments = [
        assigned(1, 1, 1, start_date="2021-01-01"),
        assigned(2, 1, 2, start_date="2021-10-01"),  # began after the ask
        assigned(3, 1, 3, start_date="2021-01-01", stop_date="2021-08-01"),  # stopped before it
        assigned(4, 1, 4, start_date="2021-01-01", stop_date="2021-06-30"),  # not in the window
        assigned(5, 3, 1, start_date="2021-01-01"),  # not staff
        assigned(6, 1, 1, office="B", start_date="2021-01-01"),  # not a portfolio unit
    ]
    got = rows(run(assignments, proposals), "assignment_entity_id", "proposal_id", "asks")
    assert got == [(1, 1, 1), (1, 2, None), (1, 3, None)]


def test_commits(run):
    proposals = [
        held(1, granted_amt=50, stop_dt="2021-09-01"),
        held(2, granted_amt=50, stop_dt="2021-06-01"),
        held(3, granted_amt=0, stop_dt="2021-09-01"),
        held(4, granted_amt=50, stop_dt="2021-09-01", proposal_type=None),
    ]
    assignments = [assigned(i, 1, i, start_date="2021-01-01") for i in (1, 2, 3, 4)]
    assert rows(run(assignments, proposals), "proposal_id", "commits", "commit_amt") == [
        (1, 1, Decimal("50.00")),
        (2, None, None),
        (3, None, None),
        (4, 4, None),  # an unknown type is neither ESP nor another type
    ]


def test_esp_takes_gift_amounts(run):
    gift = lambda amount, **more: dict(
        proposal_id=1, donor_entity_id_nbr=101, gift_credit_dt="2021-10-01",
        pledged_basis_flg="Y", transaction_credited_amt=amount) | more
    gifts = [
        gift(5), gift(7), gift(7),
        gift(9, pledged_basis_flg="N"), gift(9, gift_credit_dt="2021-01-01"),
        gift(9, donor_entity_id_nbr=5),
        gift(8, proposal_id=2, donor_entity_id_nbr=102),
    ]
    proposals = [
        held(1, proposal_type="ESP", granted_amt=50, stop_dt="2021-09-01"),
        held(2, granted_amt=60, stop_dt="2021-09-01"),
        held(3, proposal_type="ESP", granted_amt=50, stop_dt="2021-09-01"),
    ]
    assignments = [assigned(i, 1, i, start_date="2021-01-01") for i in (1, 2, 3)]
    assert rows(run(assignments, proposals, gifts), "proposal_id", "commit_amt") == [
        (1, Decimal("5.00")),
        (1, Decimal("7.00")),
        (2, Decimal("60.00")),
        (3, None),
    ]
    apart = run(assignments, proposals, gifts, dedupe_gifts=False)
    assert rows(apart.filter("proposal_id = 1"), "commit_amt", "gift_copies") == [
        (Decimal("5.00"), 1),
        (Decimal("7.00"), 2),
    ]


def _contact(i, **more):
    return dict(report_id=i, contact_date="2021-09-01", contact_type="V") | more


def test_contacts_match_once_per_activity_row(table, spark):
    activity = spark.createDataFrame(
        [(1, "A"), (1, "A"), (1, "B"), (2, "A")], "assignment_entity_id long, office_code string"
    )
    contacts = table("contact", [
        # credit and author are the same person, both units the same: still one match per row
        _contact(1, contact_credit_entity_id=1, author_entity_id=1,
                 contact_credit_unit_code="A", unit_code="A"),
        _contact(2, contact_credit_entity_id=1, author_entity_id=2,
                 contact_credit_unit_code="B", unit_code="A"),
        _contact(3, contact_credit_entity_id=None, author_entity_id=9,
                 contact_credit_unit_code="A", unit_code=None),
        _contact(4, contact_credit_entity_id=1, contact_credit_unit_code="A",
                 contact_date="2021-01-01"),
    ])
    got = portfolio_contacts(activity, contacts, START, END)
    assert rows(got, "report_id", "assignment_entity_id", "office_code", "activity_rows") == [
        (1, 1, "A", 2), (2, 1, "A", 2), (2, 1, "B", 1), (2, 2, "A", 1),
    ]
    repeated = portfolio_contacts(activity, contacts, START, END, repeat=True)
    assert rows(repeated, "report_id", "assignment_entity_id") == [
        (1, 1), (1, 1), (2, 1), (2, 1), (2, 1), (2, 2),
    ]


def test_repeated_contacts_equal_the_or_join(table, spark):
    rng = random.Random(3)
    pick = lambda values: rng.choice(values)
    people, units = [1, 2, 3, None], ["A", "B", None]
    activity = spark.createDataFrame(
        [(pick(people), pick(units)) for _ in range(40)],
        "assignment_entity_id long, office_code string",
    )
    contacts = table("contact", [
        _contact(i % 25, contact_credit_entity_id=pick(people), author_entity_id=pick(people),
                 contact_credit_unit_code=pick(units), unit_code=pick(units)) for i in range(60)
    ])
    a, c = activity.alias("a"), contacts.alias("c")
    person = F.col("a.assignment_entity_id")
    unit = F.col("a.office_code")
    joined = a.join(c, (
        (F.col("c.contact_credit_entity_id") == person) | (F.col("c.author_entity_id") == person)
    ) & ((F.col("c.contact_credit_unit_code") == unit) | (F.col("c.unit_code") == unit)))
    expected = rows(joined, "c.report_id", "a.assignment_entity_id")
    got = portfolio_contacts(activity, contacts, START, END, repeat=True)
    assert rows(got, "report_id", "assignment_entity_id") == expected


def test_enriched_contacts(table):
    contacts = table("contact", [
        _contact(1, contact_entity_id=10, contact_alt_entity_id=11, contact_credit_entity_id=1,
                 author_entity_id=2),
        _contact(2, contact_entity_id=99, author_entity_id=2),
        _contact(3, contact_date="2022-07-01"),
        _contact(4, contact_date="2021-07-02", contact_credit_entity_id=99, author_entity_id=2),
    ])
    entity = table("entity", [
        dict(entity_id=10, hh_corp_entity_id=50), dict(entity_id=11, hh_corp_entity_id=51),
        dict(entity_id=1, report_name="One"), dict(entity_id=2, report_name="Two"),
    ])
    dates = table("date_dim", [dict(calendar_dt=__import__("datetime").date(2021, 9, 1),
                                    fiscal_yr=2022)])
    columns = ["report_id", "fiscal_yr", "hh_corp_entity_id", "alt_hh_corp_entity_id",
               "fundraiser_name"]
    assert rows(contacts_enriched(contacts, entity, dates, START, END), *columns) == [
        (1, 2022, 50, 51, "One"),
        (2, 2022, None, None, "Two"),
        (4, None, None, None, "Two"),
    ]
    some = contacts_enriched(contacts, entity, dates, START, END, fundraisers=[1, 99])
    assert rows(some, "report_id") == [(1,), (4,)]


def test_contacts_in_role_keep_their_number(table, spark):
    contacts = table("contact", [
        _contact(1, contact_credit_entity_id=1, author_entity_id=1),
        _contact(1, contact_credit_entity_id=1, author_entity_id=1),
        _contact(2, contact_credit_entity_id=5, author_entity_id=1),
        _contact(3, contact_credit_entity_id=None, author_entity_id=5),
    ])
    roles = spark.createDataFrame([(1,), (1,)], "fundraiser_entity_id long")
    assert rows(contacts_in_role(contacts, roles), "report_id") == [(1,), (1,), (2,)]
