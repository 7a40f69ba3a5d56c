"""Facts stored together: bucketed and sorted by one key, so that joins on it need no shuffle.

``write_colocated`` writes tables into buckets of the key and finds the keys that hold more than a share of
a table's rows. Those would each make one oversized task in a join of buckets; their number is bounded by
the share (at most 1 / share per table), so they are kept as plain values. The number of buckets follows
the rows, so that a bucket, which one task reads and sorts, does not grow with the tables. Inside ``with
colocated(layout):`` the joins of operators on that key join buckets in place, and split only the rows of
hot keys as joins without a layout do (``plans.skew.splittable_join``).
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeline.plans.skew import Layout

#: A key is hot if it has more than this share of a table's rows, and more rows than one task should read.
HOT_SHARE = 1 / 1024
HOT_ROWS = 1 << 20

#: Rows of a table that a bucket holds about, hot keys apart: what one task sorts in a few hundred MB.
BUCKET_ROWS = 1 << 19


def working_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see, removed when the application ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "pledgeline")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return path.toString()


def _frequent_keys(table: DataFrame, key: str, rows: int) -> tuple[int, dict]:
    """The number of rows and the keys with more than ``rows`` of them, in one pass.

    Such keys are less than one in ``rows`` rows, so they are few enough for the driver.
    """
    counts = table.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    often = F.when((F.col("n") > rows) & F.col(key).isNotNull(), F.struct(F.col(key).alias("k"), "n"))
    total, found = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.collect_list(often)).first()
    return total, {r["k"]: r["n"] for r in found}


def _hot(total: int, found: Mapping, share: float) -> list:
    return sorted(k for k, n in found.items() if n > share * total)


def hot_keys(
    table: DataFrame, key: str, share: float = HOT_SHARE, rows: int = HOT_ROWS
) -> list:
    """The keys with more than a share of the rows and more than ``rows``, by one count per key."""
    return _hot(*_frequent_keys(table, key, rows), share)


def write_colocated(
    tables: Mapping[str, DataFrame],
    names: Mapping[str, str],
    location: str,
    buckets: int,
    key: str = "proposal_id",
    share: float = HOT_SHARE,
    rows: int = HOT_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> Layout:
    """Write model tables below ``location``, as catalog tables of the given names; return their layout.

    All have the same number of buckets: ``buckets``, or as many as the largest table needs to have no more
    than ``bucket_rows`` rows in each.
    Rows of ordinary keys are dealt to one task per bucket, so a bucket is one sorted file; rows of hot
    keys are written by the tasks that read them.
    """
    counted = {name: _frequent_keys(tables[name], key, rows) for name in names}
    buckets = max([buckets, *[math.ceil(total / bucket_rows) for total, _ in counted.values()]])
    hot = set()
    for name, catalog_name in names.items():
        table = tables[name]
        own = _hot(*counted[name], share)
        hot.update(own)
        if own:
            is_hot = F.coalesce(F.col(key).isin(own), F.lit(False))
            dealt = table.filter(~is_hot).repartition(buckets, key).union(table.filter(is_hot))
        else:
            dealt = table.repartition(buckets, key)
        (
            dealt.write.bucketBy(buckets, key)
            .sortBy(key)
            .option("path", f"{location}/{catalog_name}")
            .saveAsTable(catalog_name, format="parquet", mode="overwrite")
        )
    return Layout(key, tuple(sorted(hot)))
