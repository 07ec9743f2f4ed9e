"""Display labels and colour bands of the dashboard."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.numeric import half_even

# Month abbreviations, band names and their limits, currency scales and
# formats, texts around a deviation.
MONTH_ABBREVIATIONS = {
    1: "Jan", 2: "Fev", 3: "Mar", 4: "Abr", 5: "Mai", 6: "Jun",
    7: "Jul", 8: "Ago", 9: "Set", 10: "Out", 11: "Nov", 12: "Dez",
}
GREEN, YELLOW, RED, MUTED, ORANGE = "green", "yellow", "red", "muted", "orange"
ON_TARGET_PCT = 100.0
NEAR_TARGET_PCT = 85.0
MILLION = 1_000_000.0
THOUSAND = 1_000.0
MILLIONS_FORMAT = "R$ %.2fM"
THOUSANDS_FORMAT = "R$ %.1fK"
UNITS_FORMAT = "R$ %,.2f"
UP, DOWN = "▲ ", "▼ "
VERSUS_TARGET = " vs meta"


def month_abbreviation(month: Column) -> Column:
    """Portuguese abbreviation; NULL for a number that is no month."""
    names = F.create_map(*[F.lit(x) for x in chain(*MONTH_ABBREVIATIONS.items())])
    return F.try_element_at(names, month.cast("int"))


def attainment_band(pct: Column) -> Column:
    """A NULL percentage (no target) is red."""
    return (
        F.when(pct >= ON_TARGET_PCT, GREEN)
        .when(pct >= NEAR_TARGET_PCT, YELLOW)
        .otherwise(RED)
    )


def sign_band(value: Column) -> Column:
    return F.when(value >= 0, GREEN).otherwise(RED)


def currency(value: Column) -> Column:
    """``R$ 1.12M``, ``R$ 1.2K`` or ``R$ 12.50``, chosen by absolute value."""
    amount = value.cast("double")
    return (
        F.when(
            F.abs(amount) >= MILLION,
            F.format_string(MILLIONS_FORMAT, half_even(amount / MILLION, 2)),
        )
        .when(
            F.abs(amount) >= THOUSAND,
            F.format_string(THOUSANDS_FORMAT, half_even(amount / THOUSAND, 1)),
        )
        .when(amount.isNotNull(), F.format_string(UNITS_FORMAT, half_even(amount, 2)))
    )


def thousands(value: Column) -> Column:
    """Integer with ``.`` between groups of three digits."""
    return F.replace(F.format_number(value.cast("long"), 0), F.lit(","), F.lit("."))


def percent(value: Column, digits: int) -> Column:
    return F.when(
        value.isNotNull(), F.format_string(f"%.{digits}f%%", half_even(value, digits))
    )


def versus_target(deviation: Column) -> Column:
    arrow = F.when(deviation >= 0, UP).otherwise(DOWN)
    return F.concat(arrow, currency(F.abs(deviation)), F.lit(VERSUS_TARGET))
