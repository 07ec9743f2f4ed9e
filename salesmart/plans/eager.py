"""Totals straight from the sales, summed before they meet the buyers' addresses.

A sale counts once per address of its buyer, and all addresses of a buyer get the same
sales. So lines are summed per invoice, invoices per period and buyer, and only these sums
meet the addresses: as a factor where addresses are not told apart, else once per buyer
and place. No row of the fact is ever repeated, and no locality needs a key.

Every sum is partly done on the map side of its shuffle, so a hot invoice, buyer or place
sends a few rows per task. Decimal times a count is exact, so the totals are those of the
fact.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import total_money
from salesmart.operators.staging import stage
from salesmart.plans import marts
from salesmart.plans.dims import localidade_rows
from salesmart.plans.fact import STORE_DAY, invoices, lines_of
from salesmart.sources.calendar import days
from salesmart.sources.tables import SalesSource

_SUMS = {"qtd": "quantidade", "real": "valor_venda_real", "esperado": "valor_unitario"}
#: Addresses of a person are counted in this type: its digits bound those of a product.
_COUNT = "decimal(10,0)"


def _known_lines(src: SalesSource, headers: DataFrame | None) -> DataFrame:
    """Lines of products that exist, as the fact has them."""
    products = src.produto.select(F.col("id").alias("id_produto"))
    return lines_of(src, headers).join(products, "id_produto", "left_semi")


def buyer_totals(
    src: SalesSource, tempo: DataFrame, period: list[str],
    first: date | None = None, last: date | None = None,
) -> DataFrame:
    """Sums per period of the calendar and buyer; sales outside the calendar are left out.

    Lines are summed per invoice on the shuffle that joins them to their headers.
    """
    calendar = days(tempo.withColumnRenamed("data", STORE_DAY), STORE_DAY, *period)
    headers = invoices(src, first, last).join(calendar, STORE_DAY) \
        .select("id_nota", "id_cliente", *period)
    known = None
    if first is not None and last is not None:
        known = headers = stage(headers, "headers")
    per_invoice = _known_lines(src, known).groupBy("id_nota").agg(
        *[F.sum(column).alias(name) for name, column in _SUMS.items()])
    return headers.join(per_invoice, "id_nota").groupBy(*period, "id_cliente").agg(
        *[F.sum(name).alias(name) for name in _SUMS])


def _times(n: Column) -> list[Column]:
    """Sums repeated ``n`` times."""
    return [(F.col("qtd") * n.cast("long")).alias("qtd"),
            *[(F.col(name) * n.cast(_COUNT)).alias(name) for name in ("real", "esperado")]]


def monthly_sales(
    src: SalesSource, tempo: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Monthly mart rows: a buyer's sums times the number of addresses, at least once."""
    addresses = localidade_rows(src).groupBy(F.col("id_pessoa").alias("id_cliente")) \
        .agg(F.count(F.lit(1)).alias("n"))
    month = ["ano", "mes"]
    return (
        buyer_totals(src, tempo, month, first, last).join(addresses, "id_cliente", "left")
        .select(*month, *_times(F.coalesce("n", F.lit(1))))
        .groupBy(*month).agg(*marts.totals(*_SUMS))
    )


def _per_place(
    src: SalesSource, tempo: DataFrame, period: list[str], place: list[str],
    rows: DataFrame, first: date | None, last: date | None,
) -> DataFrame:
    """A buyer's sums at each place, times the number of addresses there."""
    at = rows.groupBy(F.col("id_pessoa").alias("id_cliente"), *place) \
        .agg(F.count(F.lit(1)).alias("n"))
    return buyer_totals(src, tempo, period, first, last).join(at, "id_cliente") \
        .select(*period, *place, *_times(F.col("n")))


def locality_sales(
    src: SalesSource, tempo: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Locality mart rows; sales without a complete locality are left out."""
    place = [c for c in marts.PLACE if c != "ano"]
    complete = localidade_rows(src).dropna(subset=place)
    at_place = _per_place(src, tempo, ["ano"], place, complete, first, last)
    return marts.with_attainment(at_place.groupBy(*marts.PLACE).agg(*marts.totals(*_SUMS)))


def revenue_by_state(src: SalesSource, tempo: DataFrame) -> DataFrame:
    """Revenue per state; NULL is 'state unknown'."""
    # One period for all days of the calendar.
    always = tempo.withColumn("sempre", F.lit(1))
    at_state = _per_place(
        src, always, ["sempre"], ["sigla_estado"], localidade_rows(src), None, None)
    return marts.by_revenue(at_state.groupBy("sigla_estado").agg(
        total_money("real").alias("faturamento")))


def years_with_sales(src: SalesSource, tempo: DataFrame) -> DataFrame:
    """Years of the calendar with an invoice that has a line: no amount is read."""
    calendar = days(tempo.withColumnRenamed("data", STORE_DAY), STORE_DAY, "ano")
    sold = _known_lines(src, None).select("id_nota").distinct()
    return invoices(src, None, None).join(calendar, STORE_DAY) \
        .join(sold, "id_nota", "left_semi").select("ano").distinct()
