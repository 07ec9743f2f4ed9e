"""Intermediate tables in the shared scratch folder.

A staged table is ordinary Parquet: it cuts the lineage, survives the loss of any
executor, and its file size is known to Catalyst, so a later join broadcasts it
only when it really is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="salesmart-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder, grouped by application."""
    application = spark.sparkContext.applicationId
    return f"{scratch_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"


_REMOVES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs within removes its shuffle files at its end. Else they stay until the driver
    happens to collect its garbage, and those of many staged tables lie on the disks at once."""
    before = spark.conf.get(_REMOVES_SHUFFLES)
    spark.conf.set(_REMOVES_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVES_SHUFFLES, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and go on from the written copy."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove everything that this application has staged."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{scratch_folder(spark)}/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
