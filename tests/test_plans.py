"""Plans: hot keys are split, nothing quadratic or unpruned is planned."""

import re

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

import __spark_entry__ as registry
from pledgeline.plans.settings import ADAPTIVE, apply, settings_for
from pledgeline.plans.skew import splittable_join


@pytest.fixture
def settings(spark):
    changed = {}

    def use(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("_", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield use
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _without_subqueries(plan):
    """The lines of a plan but those of subqueries, which make the bitmaps, of a fixed size."""
    kept, depth = [], None
    for line in plan.splitlines():
        at = re.search(r"\w", line)
        if depth is not None and at and at.start() > depth:
            continue
        depth = at.start() if at and line[at.start() :].startswith("Subquery") else None
        if depth is None:
            kept.append(line)
    return "\n".join(kept)


def _skewed(spark):
    """A third of the facts on one key; the lookup aggregated on that key."""
    facts = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000).cast("long").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    lookup = spark.range(0, 10_000).groupBy((F.col("id") % 5_000).alias("k")).agg(
        F.max("id").alias("top")
    )
    return facts, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_oversized_partition_is_split(spark, settings, how):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive_autoBroadcastJoinThreshold="-1",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="1MB",
        adaptive_advisoryPartitionSizeInBytes="1MB",
        adaptive_skewJoin_skewedPartitionFactor="1.5",
        shuffle_partitions="16",
    )
    facts, lookup = _skewed(spark)
    measure = [F.count("payload").alias("n"), F.max("payload").alias("last")]
    if how != "left_semi":
        measure.append(F.max("top"))
    counted = splittable_join(facts, lookup, ["k"], how).groupBy("k").agg(*measure)
    assert dict(rows(counted, "k", "n"))[7] == 100_000 + 40
    counted.collect()
    assert "skew=true" in _plan(counted)
    # a plain join on the aggregated side is not split
    plain = facts.join(lookup, "k", how).groupBy("k").agg(*measure)
    plain.collect()
    assert "skew=true" not in _plan(plain)


def test_splittable_join_equals_plain_join(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k long, v string")
    lookup = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 30)], "k long, w long")
    for how in ("inner", "left", "left_semi"):
        assert rows(splittable_join(facts, lookup, ["k"], how)) == rows(
            facts.join(lookup, "k", how)
        )


def test_settings(spark):
    made = settings_for(shuffle_bytes=10 << 40, cores=4000)
    assert made["spark.sql.shuffle.partitions"] == str(10 << 40 >> 28)
    before = spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin")
    apply(spark, ADAPTIVE)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", before)


QUERIES = sorted(registry.QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_multiplies_or_leaves_spark(spark, settings, name):
    settings(autoBroadcastJoinThreshold="-1")
    df = registry.queries()[name](spark, SMALL)
    plan = _without_subqueries(_plan(df))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "Scan ExistingRDD"):
        assert bad not in plan, bad
    if not name.startswith("trend_"):  # those end in one row per fiscal year
        assert "SinglePartition" not in plan
    if name in SHUFFLED_ONLY:
        assert "BroadcastExchange" not in plan


# nothing is broadcast unless Spark finds it small; other queries broadcast the calendar of the window
SHUFFLED_ONLY = {
    "active_portfolio",
    "planned_ask_rows",
    "actual_asks",
    "first_forward_moves",
    "first_forward_moves_lines",
    "planned_asks_by_fundraiser",
    "planned_asks_by_unit",
    "activity_window",
    "portfolio_contacts",
    "qualifications",
    "qualification_exclusions",
    "unit_qualified",
    "unit_outcomes",
    "total_qualifications",
    "proposal_window_portfolio",
    "proposal_fact",
    "scoped_proposals",
}


# sorted aggregates are left over goals (one row per person and year) and over rows that a window has
# sorted by the same keys already
SORTED_AGGREGATES = {
    "current_role",
    "active_portfolio_filtered",
    "active_portfolio_in_role",
    *[q for q in QUERIES if q.startswith(("first_forward", "dashboard_"))],
    "scoped_qualifications",
    "trend_qualifications",
    # sorted by the key of the join that follows
    "contacts_enriched",
    "scoped_contacts",
}


@pytest.mark.parametrize("name", ["contacts_enriched", "scoped_contacts"])
def test_contacts_meet_entities_once(spark, settings, name):
    settings(autoBroadcastJoinThreshold="-1")
    plan = _without_subqueries(_plan(registry.queries()[name](spark, SMALL)))
    # the entities of the sample are customers and suppliers
    assert len(re.findall(r"Scan parquet \S*\[c_custkey", plan)) == 1
    # the wide rows of contacts are shuffled once for the entities, by all people they name
    assert not re.search(r"hashpartitioning\(contact_(alt_)?entity_id#\w+, \d+\)", plan)


@pytest.mark.parametrize("name", ["contacts_enriched", "scoped_contacts"])
def test_people_of_contacts_are_sorted_once(spark, settings, name):
    """Only after they met the entities, by combination: one sort each, in tasks of equal size."""
    settings(autoBroadcastJoinThreshold="-1")
    lines = _without_subqueries(_plan(registry.queries()[name](spark, SMALL))).splitlines()
    by_named = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(_named#\w+, \d", line)]
    assert by_named and not any("SortAggregate" in lines[i + 1] for i in by_named)
    found = next(line for line in lines[by_named[0] :] if "Join [" in line)
    assert "ShuffledHashJoin [_key" in found


@pytest.mark.parametrize("name", QUERIES)
def test_facts_are_combined_by_hash(spark, settings, name):
    settings(autoBroadcastJoinThreshold="-1")
    plan = _without_subqueries(_plan(registry.queries()[name](spark, SMALL)))
    assert "ObjectHashAggregate" not in plan
    if name not in SORTED_AGGREGATES:
        assert not re.search(r"\bSortAggregate", plan)


def test_total_qualifications_reads_its_inputs_once(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = _plan(registry.queries()["total_qualifications"](spark, SMALL))
    # assignments of the sample are three files each, once dated and once not
    assert len(re.findall(r"Scan parquet", plan)) <= 13


def test_people_of_a_role_filter_contacts_before_the_first_shuffle(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = _plan(registry.queries()["scoped_contacts"](spark, SMALL))
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Scan parquet" in line and "l_suppkey" in line)
    above = plan.splitlines()[:scan]
    condition = max(i for i, line in enumerate(above) if "Filter" in line and "l_shipdate" in line)
    exchange = max(i for i, line in enumerate(above) if "Exchange hashpartitioning(order_id" in line)
    assert condition > exchange and "subquery" in above[condition]


def test_scans_are_pruned_and_filtered(spark):
    plan = registry.queries()["trend_visits"](spark, SMALL)._jdf.queryExecution().toString()
    scan = next(s for s in re.findall(r"FileScan parquet .*", plan) if "l_shipdate" in s)
    assert "l_extendedprice" not in scan and "l_tax" not in scan
    assert "PushedFilters" in scan and "l_returnflag" in scan.split("PushedFilters")[1]


@pytest.mark.parametrize(
    "name", [q for q in QUERIES if q.startswith(("trend_asks", "trend_commits", "dashboard_"))]
)
def test_trends_do_not_group_by_what_they_do_not_read(spark, name):
    plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "proposal_title" not in plan


def test_numbering_evaluates_the_portfolio_once(spark, settings):
    """Rows and blocks of all three numberings read the same exchanges: at most each file once or twice."""
    settings(autoBroadcastJoinThreshold="-1", adaptive_autoBroadcastJoinThreshold="-1")
    df = registry.queries()["active_portfolio"](spark, SMALL)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet", final)) <= 8
    assert "ReusedExchange" in final


@pytest.mark.parametrize("name", ["proposal_fact", "proposal_fact_whole", "scoped_proposals"])
def test_rows_as_wide_as_the_fact_are_not_shuffled(spark, settings, name):
    """Assignments are joined last: prospects and entities are on the proposals by then."""
    settings(autoBroadcastJoinThreshold="-1")
    plan = _plan(registry.queries()[name](spark, SMALL))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "SortMergeJoin [proposal_id" in joins[0]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(prospect_id" in line]
    assert exchanges and "Scan parquet" in plan
    # below the exchanges by prospect there are customers and orders, but no line items
    depth = lambda line: re.search(r"\w", line).start()
    lines = plan.splitlines()
    for top in exchanges:
        at = lines.index(top)
        for line in lines[at + 1 :]:
            if depth(line) <= depth(top):
                break
            assert "l_orderkey" not in line
