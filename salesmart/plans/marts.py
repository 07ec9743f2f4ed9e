"""Monthly and locality marts of revenue against target."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import attainment_stored, total_money, total_quantity
from salesmart.operators.keys import dense_keys
from salesmart.sources.calendar import days

MEASURES = ["quantidade", "valor_unitario", "valor_venda_real"]
_MONTH = ["ano", "mes"]
PLACE = ["ano", "sigla_estado", "estado", "cidade"]


def totals(quantity: str, real: str, target: str) -> list[Column]:
    """The target of a group is the sum of its unit prices, not times quantity."""
    return [
        total_quantity(quantity).alias("qtde_vendida"),
        total_money(real).alias("valor_total_real"),
        total_money(target).alias("valor_total_esperado"),
    ]


def month_totals(lines: DataFrame) -> DataFrame:
    """Totals per year and month of rows that carry ``ano`` and ``mes``."""
    return lines.groupBy(*_MONTH).agg(
        *totals("quantidade", "valor_venda_real", "valor_unitario")
    )


def monthly_sales(fact: DataFrame, tempo: DataFrame) -> DataFrame:
    """Monthly mart rows; sales outside the calendar are left out."""
    return month_totals(fact.join(days(tempo, "sk_tempo", *_MONTH), "sk_tempo"))


def locality_sales(fact: DataFrame, tempo: DataFrame, localidade: DataFrame) -> DataFrame:
    """Locality mart rows; sales without a complete locality are left out.

    Sales are first summed per year and locality key, partly on the map side, so
    the join with the locality dimension shuffles a row per key and year and not
    the fact, and a locality with a third of all sales is no hot key there.
    """
    return locality_of_sums(
        fact.where(F.col("sk_localidade").isNotNull())
        .join(days(tempo, "sk_tempo", "ano"), "sk_tempo")
        .groupBy("ano", "sk_localidade")
        .agg(*[F.sum(c).alias(c) for c in MEASURES]),
        localidade,
    )


def locality_of_sums(per_key: DataFrame, localidade: DataFrame) -> DataFrame:
    """Locality mart rows of sums per year and locality key."""
    places = localidade.select("sk_localidade", "sigla_estado", "estado", "cidade")
    return with_attainment(
        per_key.join(places.dropna(), "sk_localidade")
        .groupBy(*PLACE)
        .agg(*totals("quantidade", "valor_venda_real", "valor_unitario"))
    )


def with_attainment(locality: DataFrame) -> DataFrame:
    return locality.withColumn(
        "pct_atingimento",
        attainment_stored(F.col("valor_total_real"), F.col("valor_total_esperado")),
    )


def mart_ano_mes(monthly: DataFrame) -> DataFrame:
    """Monthly rows numbered in key order.

    There is one row per calendar month, so the window is small at any scale.
    """
    number = F.row_number().over(Window.orderBy(*_MONTH)).cast("long").alias("id")
    return monthly.select(number, *monthly.columns)


def mart_localidade(locality: DataFrame) -> DataFrame:
    """Locality rows numbered in key order."""
    return dense_keys(locality, "id", PLACE)


def stamped(mart: DataFrame, run_ts: datetime) -> DataFrame:
    """Add the audit timestamp of the run, floored to the second."""
    return mart.withColumn("data_atualizacao", F.date_trunc("second", F.lit(run_ts)))


def revenue_by_state(fact: DataFrame, tempo: DataFrame, localidade: DataFrame) -> DataFrame:
    """Revenue per state straight off the star schema; NULL is 'state unknown'."""
    per_key = (
        fact.where(F.col("sk_localidade").isNotNull())
        .join(days(tempo, "sk_tempo"), "sk_tempo")
        .groupBy("sk_localidade")
        .agg(F.sum("valor_venda_real").alias("real"))
    )
    places = localidade.select("sk_localidade", "sigla_estado")
    return by_revenue(
        per_key.join(places, "sk_localidade")
        .groupBy("sigla_estado")
        .agg(total_money("real").alias("faturamento"))
    )


def by_revenue(states: DataFrame) -> DataFrame:
    return states.orderBy(F.col("faturamento").desc(), "sigla_estado")
