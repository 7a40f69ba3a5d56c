"""Session settings for running the operators on a cluster."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Fixed for every size: adaptive execution, and splitting of skewed join partitions even where that
# costs an additional exchange.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def settings_for(shuffle_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job whose largest exchange moves about ``shuffle_bytes``.

    Partitions of 256 MB fit an executor core with a few GB; adaptive execution merges the small
    ones again, so erring on the high side is cheap.
    """
    partitions = max(cores, math.ceil(shuffle_bytes / partition_bytes))
    return ADAPTIVE | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def apply(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark
