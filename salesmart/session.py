"""Spark session with the settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join strategies from real sizes, splits skewed join
# partitions and sizes output partitions; none of the plans hints a data-dependent
# broadcast. Where every partition of one side turns out small, a hash join saves the
# sort of the invoice lines. Calendar dates are compared in UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Merge small shuffle partitions up to the advisory size even if that leaves fewer
# tasks than cores; files written after a rebalance get about this size too.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def local_session(
    cores: int | str = "*", partitions: int = 8, memory: str = "4g", **extra: str
) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("salesmart")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", 32)
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session(name: str = "salesmart") -> SparkSession:
    """A session for spark-submit, which sets master, sizes and spark.checkpoint.dir.

    Give it ``spark.sql.shuffle.partitions`` of about the shuffled bytes / 128 MB;
    adaptive execution merges what is smaller and splits what is skewed.
    """
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **CLUSTER_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
