import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pledgeline.operators.contacts import contacts_in_role
from pledgeline.plans.membership import bitmap, may_hold


@pytest.mark.parametrize("bits", [1, 64, 100, 1 << 12, 1 << 20])
def test_bitmap_never_loses_a_key(spark, bits):
    draw = random.Random(bits)
    held = {draw.randrange(-(1 << 63), 1 << 63) for _ in range(300)} | {0, -1}
    others = {draw.randrange(1 << 62) for _ in range(2000)} - held
    keys = spark.createDataFrame([(k,) for k in [*held, None]], "k long")
    asked = spark.createDataFrame([(k,) for k in [*held, *others, None]], "k long")
    words = bitmap(keys, bits)
    passed = {r.k for r in asked.filter(may_hold(words, F.col("k"), bits)).collect()}
    assert held <= passed and None not in passed
    if bits == 1 << 20:
        assert len(passed - held) < 20
    if bits == 1:
        assert others <= passed


def test_empty_set(spark):
    words = bitmap(spark.createDataFrame([], "k long"))
    assert spark.range(10).filter(may_hold(words, F.col("id"))).count() == 0


def test_contacts_in_role_are_exact_whatever_the_bitmap_lets_through(spark, table, monkeypatch):
    from pledgeline.operators import contacts

    draw = random.Random(3)
    people = [None, *range(40)]
    held = [
        dict(report_id=i, contact_credit_entity_id=draw.choice(people),
             author_entity_id=draw.choice(people)) for i in range(400)
    ]
    wanted = {3, 4, 17}
    roles = spark.createDataFrame([(p,) for p in [*wanted, 3]], "fundraiser_entity_id long")
    expected = [
        (c["report_id"],) for c in held
        if wanted & {c["contact_credit_entity_id"], c["author_entity_id"]}
    ]
    for bits in (2, 1 << 20):
        monkeypatch.setattr(contacts, "bitmap", lambda k, b=bits: bitmap(k, b))
        monkeypatch.setattr(contacts, "may_hold", lambda w, k, b=bits: may_hold(w, k, b))
        assert rows(contacts_in_role(table("contact", held), roles), "report_id") == sorted(
            expected, key=repr)
