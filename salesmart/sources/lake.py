"""Reading the year/month-partitioned Parquet lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_years(text: str) -> list[int]:
    """``"2024, 2025"`` → ``[2024, 2025]``."""
    return [int(part.strip()) for part in text.split(",")]


def read_lake(
    spark: SparkSession, path: str, schema: T.StructType, years: Sequence[int]
) -> DataFrame:
    """Rows of the given years; only their folders are read.

    A year without a folder adds no rows. If no year has any, there is nothing to
    work on and a ``ValueError`` is raised.
    """
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
    try:
        lake = reader.parquet(path).where(F.col("ano").isin(list(years)))
        found = not lake.isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = False
    if not found:
        raise ValueError(f"no Parquet rows under {path} for the years {list(years)}")
    return lake
