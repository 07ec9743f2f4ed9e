"""Rounding, ratios, labels and bands."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions import labels, numeric


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("amount, label", [
    (1125000, "R$ 1.12M"), (1250, "R$ 1.2K"), (12.5, "R$ 12.50"),
    (999.999, "R$ 1,000.00"), (-1500000, "R$ -1.50M"), (-1250, "R$ -1.2K"),
    (1000000, "R$ 1.00M"), (1000, "R$ 1.0K"), (0, "R$ 0.00"), (None, None),
])
def test_currency(spark, amount, label):
    assert value(spark, labels.currency(F.lit(amount).cast("double"))) == label


@pytest.mark.parametrize("pct, band", [
    (100.0, "green"), (99.9, "yellow"), (85.0, "yellow"), (84.9, "red"), (None, "red"),
])
def test_attainment_band(spark, pct, band):
    assert value(spark, labels.attainment_band(F.lit(pct).cast("double"))) == band


@pytest.mark.parametrize("amount, band", [(0, "green"), (5, "green"), (-1, "red"), (None, "red")])
def test_sign_band(spark, amount, band):
    assert value(spark, labels.sign_band(F.lit(amount).cast("double"))) == band


def test_month_abbreviation(spark):
    months = spark.range(0, 14).select(
        labels.month_abbreviation(F.col("id")).alias("m")).collect()
    assert [r.m for r in months] == [
        None, "Jan", "Fev", "Mar", "Abr", "Mai", "Jun",
        "Jul", "Ago", "Set", "Out", "Nov", "Dez", None]


def test_thousands_and_percent(spark):
    assert value(spark, labels.thousands(F.lit(1234567))) == "1.234.567"
    assert value(spark, labels.thousands(F.lit(12))) == "12"
    assert value(spark, labels.percent(F.lit(99.95), 1)) == "100.0%"
    assert value(spark, labels.percent(F.lit(102.5), 0)) == "102%"
    assert value(spark, labels.versus_target(F.lit(-1250))) == "▼ R$ 1.2K vs meta"


def test_ratio_without_a_whole_is_null(spark):
    for part, whole in [(5, 0), (0, 0), (None, 2), (5, None)]:
        ratio = numeric.percent_of(F.lit(part).cast("int"), F.lit(whole).cast("int"))
        assert value(spark, ratio) is None


def test_sum_of_nulls_is_zero(spark):
    frame = spark.sql("SELECT cast(null AS decimal(18,2)) AS x, cast(null AS int) AS n")
    row = frame.agg(numeric.total_money("x").alias("x"), numeric.total_quantity("n").alias("n")).first()
    assert (row.x, row.n) == (Decimal("0.00"), 0)


def test_discount_is_relative_to_the_charged_price(spark):
    listed, charged = F.lit(Decimal("25.00")), F.lit(Decimal("20.00"))
    off = numeric.discount(listed, charged)
    assert value(spark, off) == Decimal("5.00")
    assert value(spark, numeric.discount_pct(off, charged)) == Decimal("25.00")


def test_discount_out_of_range_fails(spark):
    off, charged = F.lit(Decimal("1000.00")), F.lit(Decimal("1.00"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        value(spark, numeric.discount_pct(off, charged))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=200, max_size=400))
def test_rounding_is_half_even_on_ties(spark, eighths):
    # Multiples of 1/8 are exact doubles, so every tie at two digits is a true tie.
    frame = spark.createDataFrame([(e / 8,) for e in eighths], "x double")
    got = frame.select("x", numeric.half_even(F.col("x"), 2).alias("r")).collect()
    assert [r.r for r in got] == [round(r.x, 2) for r in got]
