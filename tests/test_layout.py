"""Facts in buckets: the same rows, no exchange below joins of facts, hot keys split."""

import random
import re

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

import __spark_entry__ as registry
from check import compare
from pledgeline.operators import portfolio, qualifications
from pledgeline.plans.skew import Layout, colocated, splittable_join
from pledgeline.sources.layout import _frequent_keys, hot_keys, working_folder, write_colocated
from pledgeline.sources.schemas import SCHEMAS
from pledgeline.sources.tables import catalog_tables

NAMES = [f"{name}_colocated" for name in registry.COLOCATED]


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_same_rows(spark):
    assert compare(spark, SMALL, NAMES) == {name: "" for name in NAMES}


def _exchanges_below_joins(df, side):
    """Exchanges by proposal_id, and scans of a side that read buckets."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(proposal_id#[^,]*, \d+\)", plan), plan


def test_no_exchange_below_joins_of_facts(spark, no_broadcast):
    model = registry._Colocated(spark, SMALL)
    with colocated(model.layout):
        mine = model.portfolio()
        status = qualifications._campus_status(
            model.assignment, model.stage, model.proposal, registry.START, registry.END, None, None
        )
        fact = portfolio.planned_asks_by_fundraiser(mine)
    for df, scans in ((mine, 2), (status, 3), (fact, 4)):
        exchanges, plan = _exchanges_below_joins(df, "assignment")
        assert exchanges == [] and "_bit#" not in plan
        assert plan.count("Bucketed: true") == scans
    # without the layout every fact is shuffled
    plain = registry._Model(spark, SMALL).portfolio()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(proposal_id" in plain


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_keys_are_split_others_stay_in_place(spark, table, no_broadcast, how):
    draw = random.Random(5)
    key = lambda: 7 if draw.random() < 0.4 else draw.choice([None, *range(40)])
    facts = table("stage", [dict(proposal_stage_id=i, proposal_id=key()) for i in range(600)])
    lookup = table(
        "proposal_summary", [dict(proposal_id=p, proposal_assignments=f"p{p}") for p in [*range(5, 60), None]]
    )
    assert hot_keys(facts, "proposal_id", share=0.2, rows=10) == [7]
    names = {"stage": f"stage_{how}", "proposal_summary": f"summary_{how}"}
    layout = write_colocated(
        {"stage": facts, "proposal_summary": lookup}, names, working_folder(spark), 4, share=0.2, rows=10
    )
    assert layout == Layout("proposal_id", (7,))
    stored = catalog_tables(spark, names)
    assert rows(stored["stage"]) == rows(facts)
    with colocated(layout):
        joined = splittable_join(stored["stage"], stored["proposal_summary"], ["proposal_id"], how)
    assert rows(joined) == rows(facts.join(lookup, "proposal_id", how))
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the rows of key 7 are shuffled by key and bit, the others not at all
    assert "hashpartitioning(proposal_id" in plan and plan.count("Bucketed: true") == 2
    assert not re.search(r"hashpartitioning\(proposal_id#\w+, \d+\)", plan)


def test_catalog_tables_check_their_columns(spark, table):
    table("stage", []).withColumn("more", F.lit(1)).createOrReplaceTempView("wide_stage")
    assert catalog_tables(spark, {"stage": "wide_stage"})["stage"].columns == [
        c.split()[0] for c in SCHEMAS["stage"].split(",")
    ]
    table("stage", []).select(
        "proposal_id", F.col("stage_code").cast("int").alias("stage_code"), "stage_date"
    ).createOrReplaceTempView("narrow_stage")
    with pytest.raises(ValueError, match="proposal_stage_id is missing.*stage_code is int, not string"):
        catalog_tables(spark, {"stage": "narrow_stage"})
    with pytest.raises(ValueError, match="no model table 'stages'"):
        catalog_tables(spark, {"stages": "narrow_stage"})


def test_buckets_follow_the_rows(spark, table):
    facts = table("stage", [dict(proposal_stage_id=i, proposal_id=i % 50) for i in range(600)])
    few = table("proposal_summary", [dict(proposal_id=p, proposal_assignments=f"p{p}") for p in range(50)])
    names = {"stage": "stage_many", "proposal_summary": "summary_many"}
    write_colocated(
        {"stage": facts, "proposal_summary": few}, names, working_folder(spark), 4, bucket_rows=100
    )
    for name in names.values():
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert described["Num Buckets"] == "6"
    assert rows(catalog_tables(spark, names)["stage"]) == rows(facts)


def test_keys_and_rows_are_counted_in_one_pass(spark, table):
    made = spark.sparkContext.accumulator(0)
    facts = table("stage", [dict(proposal_id=p) for p in [7] * 30 + [None] * 40 + list(range(20))])
    assert _frequent_keys(facts, "proposal_id", 10) == (90, {7: 31})
    assert _frequent_keys(facts.limit(0), "proposal_id", 10) == (0, {})
    tapped = spark.createDataFrame(
        facts.rdd.map(lambda row: (made.add(1), row)[1]), facts.schema
    )
    assert hot_keys(tapped, "proposal_id", share=0.2, rows=10) == [7]
    assert made.value == 90


def test_only_the_facts_that_a_query_reads_are_written(spark):
    before = {t.name for t in spark.catalog.listTables()}
    model = registry._Colocated(spark, SMALL, registry.COLOCATED["active_portfolio"])
    written = {t.name.split("_")[-1] for t in spark.catalog.listTables() if t.name not in before}
    assert written == {"assignment", "proposal"}
    assert model.stage.columns == registry._Model(spark, SMALL).stage.columns


def test_numbering_reads_stored_facts_twice(spark, no_broadcast):
    """Once for the rows and once for the sizes of the blocks of all three numberings."""
    model = registry._Colocated(spark, SMALL, ("assignment", "proposal"))
    with colocated(model.layout):
        df = model.portfolio(registry.RANKS)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Bucketed: true") == 4
    assert "ReusedExchange" in final
