"""Checks of the warehouse: counts, null keys, references, totals."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.numeric import (
    discount, half_even, percent_of, total_money, total_quantity,
)
from salesmart.plans.dims import Star
from salesmart.schemas import MONEY, STORE_DAY
from salesmart.sources.calendar import days

KEYS = {
    "tempo": "sk_tempo",
    "produto": "sk_produto",
    "cliente": "sk_cliente",
    "vendedor": "sk_vendedor",
    "localidade": "sk_localidade",
}

# The tables that must not be empty for a run to pass.
REQUIRED_TABLES = ("dim_cliente", "dim_localidade", "vendas_ano_mes", "vendas_localidade")


class ValidationError(AssertionError):
    """A run left required tables empty, facts without a dimension row, or a wrong mart."""


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def validate(counts: dict[str, int]) -> None:
    """Raise with every required table that is empty or missing."""
    empty = [name for name in REQUIRED_TABLES if not counts.get(name)]
    if empty:
        raise ValidationError("empty tables: " + ", ".join(empty))


def null_keys(fact: DataFrame) -> DataFrame:
    """Number of NULLs in each surrogate key, in one pass."""
    return fact.agg(*[
        F.coalesce(F.count_if(F.col(key).isNull()), F.lit(0)).alias(key)
        for key in KEYS.values()
        if key in fact.columns
    ])


def undated(fact: DataFrame, first: date) -> int:
    """Rows of days from ``first`` on, the calendar's start, that have no day key."""
    day = F.col(STORE_DAY.name)
    return fact.where(F.col("sk_tempo").isNull() & (day >= F.lit(first))).count()


def overflow(lines: DataFrame, products: DataFrame, limit: Decimal) -> DataFrame:
    """Lines whose discount in percent of the charged price is ``limit`` or more either
    way: how many per product, and the largest share.

    Storing such a line with a limit of 1000 fails the whole run, by design; this names
    the products first. A share that fits no decimal at all counts too.
    """
    prices = products.select(F.col("id").alias("id_produto"), "valor_venda")
    off = discount(F.col("valor_venda"), F.col("valor_unitario"))
    share = half_even(percent_of(off, F.col("valor_unitario")), 2)
    fits = F.abs(share.try_cast("decimal(38,2)")) < F.lit(limit)
    return (
        lines.join(prices, "id_produto")
        .where(share.isNotNull() & ~F.coalesce(fits, F.lit(False)))
        .groupBy("id_produto")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.max(F.abs(share)).alias("largest_pct"))
    )


def referential_integrity(fact: DataFrame, star: Star) -> DataFrame:
    """Per dimension, distinct fact keys and fact rows that point to no row of it.

    The fact is counted per key first, with map-side combining, so each join with
    a dimension shuffles distinct keys only.
    """
    reports = []
    for name, key in KEYS.items():
        dimension = getattr(star, name)
        used = fact.where(F.col(key).isNotNull()).groupBy(key).count()
        missing = used.join(dimension.select(key), key, "left_anti")
        reports.append(
            missing.agg(
                F.count(F.lit(1)).alias("orphan_keys"),
                F.coalesce(F.sum("count"), F.lit(0)).alias("orphan_rows"),
            ).select(F.lit(f"dim_{name}").alias("dimension"), "orphan_keys", "orphan_rows")
        )
    return reduce(DataFrame.unionByName, reports)


def _measures(quantity: str, real: str, target: str) -> list[Column]:
    return [
        total_quantity(quantity).alias("qtde"),
        total_money(real).alias("valor_real"),
        total_money(target).alias("valor_esperado"),
    ]


def reconciliation(
    fact: DataFrame, star: Star, monthly: DataFrame, locality: DataFrame
) -> DataFrame:
    """Totals of fact and marts, with every difference split by its cause.

    fact − outside_calendar − unexplained_month = month_mart, and
    month_mart − no_locality − incomplete_locality − unexplained_locality
    = locality_mart. A non-zero unexplained row means that a mart is stale or wrong.
    """
    in_calendar = F.col("in_calendar").isNotNull()
    calendar = days(star.tempo.withColumn("in_calendar", F.lit(True)), "sk_tempo", "in_calendar")
    complete = F.col("sigla_estado").isNotNull() & F.col("estado").isNotNull() & F.col(
        "cidade"
    ).isNotNull()
    places = star.localidade.select("sk_localidade", complete.alias("complete"))
    cause = (
        F.when(~F.col("in_calendar"), "outside_calendar")
        .when(F.col("complete").isNull(), "no_locality")
        .when(~F.col("complete"), "incomplete_locality")
        .otherwise("in_both_marts")
    )
    by_cause = (
        fact.join(calendar, "sk_tempo", "left")
        .groupBy(in_calendar.alias("in_calendar"), "sk_localidade")
        .agg(
            F.sum("quantidade").alias("q"),
            F.sum("valor_venda_real").alias("r"),
            F.sum("valor_unitario").alias("e"),
        )
        .join(places, "sk_localidade", "left")
        .groupBy(cause.alias("cause"))
        .agg(*_measures("q", "r", "e"))
    )
    marts = _mart_total(monthly, "month_mart").unionByName(
        _mart_total(locality, "locality_mart")
    )
    # Six rows: each report line adds some of them and takes off others.
    parts = by_cause.unionByName(marts)
    in_month = ["no_locality", "incomplete_locality", "in_both_marts"]
    lines = [
        ("fact", ["outside_calendar", *in_month], []),
        ("outside_calendar", ["outside_calendar"], []),
        ("unexplained_month", in_month, ["month_mart"]),
        ("month_mart", ["month_mart"], []),
        ("no_locality", ["no_locality"], []),
        ("incomplete_locality", ["incomplete_locality"], []),
        ("unexplained_locality", ["month_mart"],
         ["no_locality", "incomplete_locality", "locality_mart"]),
        ("locality_mart", ["locality_mart"], []),
    ]
    report = F.array(*[
        F.struct(F.lit(position).alias("ordem"), F.lit(item).alias("item"), *_signed(plus, minus))
        for position, (item, plus, minus) in enumerate(lines, 1)
    ])
    return parts.agg(report.alias("report")).select(F.inline("report"))


def _signed(plus: list[str], minus: list[str]) -> list[Column]:
    """Each measure summed over some parts, less its sum over others."""

    def total(measure: str, kind: T.DataType) -> Column:
        value, part = F.col(measure), F.col("cause")
        signed = F.when(part.isin(plus), value).when(part.isin(minus), -value)
        return F.coalesce(F.sum(signed), F.lit(0)).cast(kind).alias(measure)

    return [total("qtde", T.LongType()), total("valor_real", MONEY), total("valor_esperado", MONEY)]


def _mart_total(mart: DataFrame, name: str) -> DataFrame:
    return mart.agg(
        *_measures("qtde_vendida", "valor_total_real", "valor_total_esperado")
    ).select(F.lit(name).alias("cause"), "qtde", "valor_real", "valor_esperado")


def run_report(orphans: DataFrame, totals: DataFrame) -> DataFrame:
    """Both checks as rows of one table: orphans per dimension, differences per item."""
    none = F.lit(None)
    return orphans.select(
        F.lit(REFERENCES).alias("verificacao"), F.col("dimension").alias("item"),
        F.col("orphan_keys").alias("chaves"), F.col("orphan_rows").alias("linhas"),
        none.cast(MONEY).alias("valor_real"), none.cast(MONEY).alias("valor_esperado"),
    ).unionByName(totals.select(
        F.lit(TOTALS).alias("verificacao"), "item", none.cast("long").alias("chaves"),
        F.col("qtde").alias("linhas"), "valor_real", "valor_esperado"))


REFERENCES, TOTALS = "referencias", "totais"

# The totals that no cause explains, and the mart that is then stale or wrong.
_UNEXPLAINED = {"unexplained_month": "vendas_ano_mes", "unexplained_locality": "vendas_localidade"}


def failures(report: list) -> list[str]:
    """What is wrong by the rows of a run's report, of which there are a few."""
    found = []
    for row in report:
        if row["verificacao"] == REFERENCES and row["chaves"]:
            found.append(f"{row['item']}: {row['linhas']} facts point to {row['chaves']} missing rows")
        wrong = _UNEXPLAINED.get(row["item"])
        if row["verificacao"] == TOTALS and wrong and any(
                row[c] for c in ("linhas", "valor_real", "valor_esperado")):
            found.append(f"{wrong}: differs from the facts by {row['valor_real']} of revenue")
    return sorted(found)
