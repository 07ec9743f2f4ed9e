"""Top-k with a stable tie rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_ranked(df: DataFrame, n: int, value: str, tie_breaker: str) -> DataFrame:
    """The ``n`` largest values with their rank; ties go to the smaller key.

    Sort and limit become one TakeOrderedAndProject; the window that writes the
    rank sees ``n`` rows.
    """
    order = [F.col(value).desc(), F.col(tie_breaker).asc()]
    rank = F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank")
    return df.orderBy(*order).limit(n).select(rank, *df.columns)
