"""A few ranges that cover scattered numbers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def covering_ranges(
    rows: DataFrame, column: str, most: int = 16, buckets: int = 4096
) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold every value of a whole-number column.

    The span is cut into equal buckets; of each occupied one the smallest and largest
    value come to the driver, at most ``buckets`` rows whatever the size of the data. The
    span is then split at its widest gaps. Gaps within a bucket are not seen, so a range
    may hold other numbers; none is lost. NULLs are in no range.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return []
    width = (high - low) // buckets + 1
    bucket = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
    occupied = sorted(
        (row["low"], row["high"])
        for row in rows.where(F.col(column).isNotNull()).groupBy(bucket.alias("bucket"))
        .agg(F.min(column).alias("low"), F.max(column).alias("high")).collect())
    gaps = sorted(
        ((after[0] - before[1], k) for k, (before, after) in enumerate(zip(occupied, occupied[1:]), 1)),
        reverse=True)
    cuts = sorted(k for gap, k in gaps[: most - 1] if gap > 1)
    return [(occupied[a][0], occupied[b - 1][1])
            for a, b in zip([0, *cuts], [*cuts, len(occupied)])]


def within(column: str, ranges: list[tuple[int, int]]) -> Column:
    """Whether a column is in one of the ranges: a filter that scans can use."""
    parts = [F.col(column).between(F.lit(low), F.lit(high)) for low, high in ranges]
    return reduce(or_, parts, F.lit(False)) if parts else F.lit(False)
