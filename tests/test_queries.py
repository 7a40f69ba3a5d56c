"""Every registered query against its SQL equivalent, and the driver's entry points."""

import pytest
from conftest import SMALL
from pyspark.sql import types as T

import __spark_entry__ as registry
import oracle_queries
from check import compare
from pledgeline.sources.schemas import SCHEMAS
from pledgeline.sources.sample import SampleTables
from pledgeline.sources.tables import catalog_tables, parquet_tables


@pytest.fixture(scope="module")
def outcome(spark):
    return compare(spark, SMALL, list(registry.QUERIES))


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle_queries.oracle_sql())
    assert set(registry.QUERIES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(outcome, name):
    assert outcome[name] == ""


def test_results_do_not_depend_on_the_size_of_blocks(spark, block_ids):
    block_ids(2)
    names = ["active_portfolio", "actual_asks", "first_forward_moves", "dashboard_long"]
    assert compare(spark, SMALL, names) == {n: "" for n in names}


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns[:4] == ["section", "fiscal_yr", "total", "ytd"] and df.count() == 56


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_sample_tables_follow_the_model(spark, name):
    """Sample tables have the declared type for every column they fill."""
    declared = {f.name: f.dataType for f in T.StructType.fromDDL(SCHEMAS[name]).fields}
    for field in SampleTables(spark, SMALL)[name].schema.fields:
        assert field.dataType == declared[field.name], field.name


def test_readers(spark, tmp_path):
    sample = SampleTables(spark, SMALL)
    for name in SCHEMAS:
        sample[name].limit(5).write.parquet(f"{tmp_path}/{name}")
    tables = parquet_tables(spark, str(tmp_path))
    assert set(tables) == set(SCHEMAS) and tables["proposal"].count() == 5
    # columns missing in the files read as NULL
    assert tables["stage"].schema == T.StructType.fromDDL(SCHEMAS["stage"])
    tables["stage"].createOrReplaceTempView("any_stage_view")
    assert catalog_tables(spark, {"stage": "any_stage_view"})["stage"].count() == 5
