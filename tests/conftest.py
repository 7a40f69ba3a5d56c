import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from pledgeline.sources.schemas import SCHEMAS  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("pledgeline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Build a model table from dicts; columns left out are NULL."""

    def build(name, rows):
        schema = T.StructType.fromDDL(SCHEMAS[name])
        return spark.createDataFrame(
            [tuple(_value(r.get(f.name), f.dataType) for f in schema.fields) for r in rows], schema
        )

    return build


def _value(value, kind):
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        from decimal import Decimal

        return Decimal(str(value))
    if isinstance(kind, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if isinstance(kind, T.TimestampType) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value


def rows(df, *columns):
    """The result as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def block_ids(monkeypatch):
    """Set the number of ids in a block, for one test."""
    from pledgeline.plans import skew

    return lambda size: monkeypatch.setattr(skew, "BLOCK_IDS", size)
