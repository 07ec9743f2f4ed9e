"""Writers of the Parquet warehouse, lake and marts."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schemas import STORE_DAY, conform
from salesmart.sinks import versions

LAKE_PARTITIONS = ("ano", "mes")
_COUNT, _DAYS = "n_rows", "days"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written instead of reading them again."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(_COUNT)), seen


def _gathered(df: DataFrame, gather: bool, *columns: str) -> DataFrame:
    """Bring equal partition values together, without one task per value.

    Rows that come out of joins hold every day in every task; written as they are,
    each task would open a file per day. Adaptive execution splits a value with very
    many rows over several tasks and merges small ones, so neither one huge nor many
    tiny files are written. Rows of a single partition value need no such shuffle.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns]) if gather else df


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table; of a table with versions the current one."""
    return spark.read.schema(schema).parquet(versions.current(spark, path))


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """None also where a first version was begun but never committed."""
    if not exists(spark, path):
        return None
    folder, files = _folder(spark, path)
    begun = [s.getPath().getName() for s in files.listStatus(folder)]
    if not versions.is_versioned(spark, path) and begun and all(
            name == versions.MANIFEST or name.startswith("data-") for name in begun):
        return None
    return read_table(spark, path, schema)


def read_fact_months(
    spark: SparkSession, path: str, schema: T.StructType, first: date, last: date
) -> DataFrame:
    """The stored facts of the months from first to last; for one month, the folders of
    the others are not even listed."""
    if (first.year, first.month) != (last.year, last.month):
        low, high = first.replace(day=1), (last.replace(day=28) + timedelta(days=4)).replace(day=1)
        day = F.col(STORE_DAY.name)
        return read_table(spark, path, schema).where((day >= F.lit(low)) & (day < F.lit(high)))
    path = versions.current(spark, path)
    folders = f"{path}/{STORE_DAY.name}={first:%Y-%m}-*"
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write a new version of a table and make it the current one."""
    spark = rows.sparkSession
    folder, number = versions.next_version(spark, path)
    rows.write.partitionBy(*partitions).parquet(folder)
    versions.commit(spark, path, folder, number)
    versions.drop_old(spark, path)


def write_full(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Full refresh of a table in one step; returns the number of rows written.

    Until the new rows are all there, readers see the rows before; ``df`` may even be read
    from the table itself.
    """
    rows, seen = _counted(conform(df, schema))
    _replace(rows, path)
    return seen.get[_COUNT]


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file; one that is there already stays."""
    file, files = _folder(spark, path)
    files.mkdirs(file.getParent())
    files.createNewFile(file)


def names_in(spark: SparkSession, path: str) -> list[str]:
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def append(df: DataFrame, path: str, schema: T.StructType) -> int:
    rows, seen = _counted(conform(df, schema))
    rows.write.mode("append").parquet(path)
    return seen.get[_COUNT]


def _store_ready(fact: DataFrame, schema: T.StructType, gather: bool) -> DataFrame:
    """Sorted as the warehouse reads it: by day key, then product key."""
    day = STORE_DAY.name
    return _gathered(conform(fact, schema), gather, day).sortWithinPartitions(
        day, "sk_tempo", "sk_produto"
    )


def write_fact_full(fact: DataFrame, path: str, schema: T.StructType) -> int:
    """Full refresh of the fact store in one step, one folder per sale date."""
    rows, seen = _counted(_store_ready(fact, schema, gather=True))
    _replace(rows, path, STORE_DAY.name)
    return seen.get[_COUNT]


def replace_fact_days(
    fact: DataFrame, path: str, schema: T.StructType, gather: bool = True
) -> tuple[int, set[date]]:
    """Replace the days that ``fact`` holds, leaving all others as they are.

    Returns the number of rows and the days, at most one entry per day of the range. The
    new folders are swapped in when the job commits. A day without rows is not touched;
    use :func:`drop_fact_days` for days corrected to empty.
    """
    seen = Observation()
    rows = _store_ready(fact, schema, gather).observe(
        seen, F.count(F.lit(1)).alias(_COUNT), F.collect_set(STORE_DAY.name).alias(_DAYS))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(STORE_DAY.name)
        .parquet(versions.current(fact.sparkSession, path))
    )
    return seen.get[_COUNT], set(seen.get[_DAYS] or ())


def drop_fact_days(spark: SparkSession, path: str, days: Iterable[date]) -> None:
    """Leave days of the fact store without rows: folders are removed, no job is run."""
    drop_partitions(spark, versions.current(spark, path), STORE_DAY.name, days)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable) -> None:
    for value in values:
        folder, files = _folder(spark, f"{path}/{column}={value}")
        files.delete(folder, True)


def partition_values(spark: SparkSession, path: str, column: str) -> set[str]:
    """Values of the folders of a table that is partitioned by one column."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return set()
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return {name.partition("=")[2] for name in names if name.startswith(f"{column}=")}


def replace_partitions(
    rows: DataFrame, path: str, schema: T.StructType, column: str
) -> set[str]:
    """Replace the values of a partition column that ``rows`` holds; returns these values."""
    seen = Observation()
    rows = _gathered(conform(rows, schema), True, column).observe(
        seen, F.collect_set(F.col(column).cast("string")).alias(_DAYS))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    )
    return set(seen.get[_DAYS] or ())


def _lake_writer(rows: DataFrame):
    return (
        rows.write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy(*LAKE_PARTITIONS)
    )


def write_lake_full(rows: DataFrame, path: str, schema: T.StructType) -> int:
    """Rewrite the whole lake, on any file system the executors can reach."""
    rows, seen = _counted(_gathered(conform(rows, schema), True, *LAKE_PARTITIONS))
    _lake_writer(rows).parquet(path)
    return seen.get[_COUNT]


def write_lake_months(
    rows: DataFrame, path: str, schema: T.StructType, gather: bool = False
) -> int:
    """Replace the months that ``rows`` holds: one snapshot per month, not per run.

    Without rows nothing is touched; a month that lost all its sales keeps its snapshot.
    """
    rows, seen = _counted(_gathered(conform(rows, schema), gather, *LAKE_PARTITIONS))
    _lake_writer(rows).option("partitionOverwriteMode", "dynamic").parquet(path)
    return seen.get[_COUNT]
