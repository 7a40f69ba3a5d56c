"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word is a run of characters other than these six white-space characters (fixed by contract).
WORD = r"[^\x20\x09-\x0D]+"

# Spark's setting for removing shuffle files when a query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables that the driver and every executor can see.

    It lies in the folder that the cluster names in ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder serves if all of Spark runs on this machine; otherwise it is an error. Spark's
    file system removes the folder when the application ends, not before: a lost executor may need
    to read the tables again as long as a result depends on them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "pledgeline-llm")
    folder = f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet below a shared folder and read it again.

    This cuts the lineage, keeps a costly step from running twice, and gives the planner the true
    size of the table: small ones are broadcast by Spark's own rule, others get an exchange of
    their own, so that adaptive execution can split hot join keys.
    """
    path = f"{folder}/{name}"
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def only_once(docs: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``docs`` whose keys (nulls equal) are in ``chosen``; of repeated rows, one.

    ``chosen`` has each combination of keys once. Columns named ``_llm_…`` are the operators' own.
    """
    # as one struct the keys are never null, and the join's exchange serves the window too
    key = F.struct(*keys)
    first = Window.partitionBy("_llm_key").orderBy(F.lit(0))
    return (
        docs.withColumn("_llm_key", key)
        .join(chosen.select(key.alias("_llm_key")), "_llm_key", "left_semi")
        .withColumn("_llm_repeat", F.row_number().over(first))
        .filter("_llm_repeat = 1")
        .select(*docs.columns)
    )
