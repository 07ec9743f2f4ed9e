"""Rounding, ratio and total expressions. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.schemas import ATTAINMENT_PCT, DISCOUNT_PCT, MONEY


def half_even(value: Column, digits: int) -> Column:
    """Half-even rounding of a double."""
    return F.bround(value.cast("double"), digits)


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` in double; NULL when the whole is zero or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def discount(list_price: Column, charged: Column) -> Column:
    return (list_price - charged).cast(MONEY)


def discount_pct(discount_value: Column, charged: Column) -> Column:
    """Discount as a share of the *charged* price."""
    return half_even(percent_of(discount_value, charged), 2).cast(DISCOUNT_PCT)


def attainment(real: Column, target: Column, digits: int) -> Column:
    """Share of the target reached, in percent, as a rounded double."""
    return half_even(percent_of(real, target), digits)


def attainment_stored(real: Column, target: Column) -> Column:
    return attainment(real, target, 2).cast(ATTAINMENT_PCT)


def total_quantity(column: str) -> Column:
    """Sum that is 0, not NULL, when every input is NULL."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def total_money(column: str) -> Column:
    """Exact decimal sum, so the result does not depend on the order of rows."""
    return F.coalesce(F.sum(column), F.lit(0)).cast(MONEY)
