"""Joins that attach surrogate keys to sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.staging import stage

# Lookup rows of one key that are joined in one place.
ROWS_PER_SALT = 100_000

_SALT, _SALTS = "_salt", "_salts"


def fan_out_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    match: str,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Left join to a lookup that may hold many rows per key; all matches are kept.

    Adaptive execution splits a hot key on the left of a left join but never on
    its right. So the lookup rows of a key are spread over salts, one for every
    ``rows_per_salt`` of them, and a left row is repeated once per salt of its key.
    Keys with several salts are a written table of at most size-of-lookup /
    ``rows_per_salt`` rows, usually none, so Catalyst sees its size. ``match`` is the
    lookup's column that tells a key's rows apart; it may be NULL in a key's only row.
    """
    salted = stage(
        lookup.groupBy(key)
        .count()
        .where(F.col("count") > rows_per_salt)
        .select(key, F.ceil(F.col("count") / rows_per_salt).cast("int").alias(_SALTS)),
        "salted_keys",
    )
    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    spread = (
        lookup.join(salted, key, "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(match), salts).cast("int"))
        .drop(_SALTS)
    )
    repeated = rows.join(salted, key, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), salts - 1))
    )
    # A key with salts has many matches, so an unmatched salt of it is no result row.
    return (
        repeated.join(spread, [key, _SALT], "left")
        .where(F.col(_SALTS).isNull() | F.col(match).isNotNull())
        .drop(_SALT, _SALTS)
    )
