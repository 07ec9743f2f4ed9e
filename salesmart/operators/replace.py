"""Replace rows by key: the result of a delete followed by an insert."""

from __future__ import annotations

from pyspark.sql import DataFrame


def replace_by_key(stored: DataFrame, key: str, keys: DataFrame, new: DataFrame) -> DataFrame:
    """``stored`` without the rows whose key is in ``keys``, plus all of ``new``.

    ``keys`` has the key column only. Rows with a NULL key are kept, as a delete with
    IN keeps them.
    """
    return stored.join(keys, key, "left_anti").unionByName(new)
