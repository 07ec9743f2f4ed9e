"""Surrogate keys 1..n in natural-key order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.staging import stage

# monotonically_increasing_id() keeps the row position in its lower 33 bits.
_POSITION_BITS = 33

_PART, _ROW = "_part", "_row"


def dense_keys(
    rows: DataFrame, sk: str, order_by: Sequence[str], start: int = 0
) -> DataFrame:
    """Number rows ``start+1 .. start+n`` in the order of ``order_by``.

    The rows are range-sorted over the whole order, so many rows that share a
    leading key are still split over tasks, and written once with their position.
    Each task's offset is the number of rows in the tasks before it.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    placed = stage(
        rows.orderBy(*order_by).select(
            "*", F.spark_partition_id().alias(_PART), position.alias(_ROW)
        ),
        sk,
    )
    # One number per sort task, so at most spark.sql.shuffle.partitions of them
    # whatever the size of the data. As a literal it leaves a plain scan: the size of
    # the dimension stays known to Catalyst, which decides on a broadcast by it.
    counts = {r[_PART]: r["count"] for r in placed.groupBy(_PART).count().collect()}
    sizes = [counts.get(part, 0) for part in range(max(counts, default=0) + 1)]
    before = F.array(*[F.lit(n).cast("long") for n in accumulate([start, *sizes])])
    key = F.element_at(before, F.col(_PART) + 1) + F.col(_ROW) + 1
    return placed.select(key.alias(sk), *rows.columns)


def new_keys(
    rows: DataFrame, sk: str, natural_key: Sequence[str], key_map: DataFrame
) -> DataFrame:
    """Key and natural key of the rows that ``key_map`` does not hold yet.

    They are numbered after the highest key ever given out.
    """
    known = key_map.select(*[F.col(c).alias(_known(c)) for c in natural_key])
    added = rows.select(*natural_key).join(known, _same(natural_key), "left_anti").distinct()
    highest = key_map.agg(F.max(sk)).first()[0] or 0
    return dense_keys(added, sk, natural_key, start=highest)


def attach_keys(
    rows: DataFrame, sk: str, natural_key: Sequence[str], key_map: DataFrame
) -> DataFrame:
    """Rows with their key from a map that holds all of them."""
    known = key_map.select(sk, *[F.col(c).alias(_known(c)) for c in natural_key])
    return rows.join(known, _same(natural_key)).select(sk, *rows.columns)


def stable_keys(
    rows: DataFrame, sk: str, natural_key: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """Keys in natural-key order; rows already in ``existing`` keep theirs.

    Without ``existing``, a full reload would renumber a dimension under the stored
    fact as soon as one natural key is inserted in the middle.
    """
    if existing is None:
        return dense_keys(rows, sk, natural_key)
    key_map = existing.select(sk, *natural_key)
    complete = key_map.unionByName(new_keys(rows, sk, natural_key, key_map))
    return attach_keys(rows, sk, natural_key, complete)


def _known(column: str) -> str:
    return f"_known_{column}"


def _same(natural_key: Sequence[str]) -> Column:
    """Equality that also matches NULL with NULL: an address may lack a district."""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(_known(c))) for c in natural_key])
