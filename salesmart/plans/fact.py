"""The sales fact: one row per invoice line and buyer address."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.functions.numeric import discount, discount_pct
from salesmart.operators.intervals import covering_ranges, within
from salesmart.operators.lookup import ROWS_PER_SALT, fan_out_join
from salesmart.operators.replace import replace_by_key
from salesmart.operators.staging import stage
from salesmart.plans.dims import Star
from salesmart.sources.calendar import days
from salesmart.sources.tables import SalesSource

STORE_DAY = schemas.STORE_DAY.name


def invoices(src: SalesSource, first: date | None, last: date | None) -> DataFrame:
    """Invoice headers of the days first..last.

    The day filter is a half-open range on the raw timestamp, so that the scan
    can use it; a filter on the truncated date could not be pushed down.
    """
    headers = src.nota_fiscal
    if first is not None:
        headers = headers.where(F.col("data_venda") >= F.lit(first))
    if last is not None:
        headers = headers.where(F.col("data_venda") < F.lit(last + timedelta(days=1)))
    return headers.select(
        F.col("id").cast("long").alias("id_nota"),
        F.to_date("data_venda").alias(STORE_DAY),
        "id_cliente",
        "id_vendedor",
    )


def lines_of(src: SalesSource, headers: DataFrame | None) -> DataFrame:
    """Invoice lines; given some written ``headers``, at least those that belong to them.

    Lines carry no date, but invoice numbers grow with time. The numbers of a few days'
    invoices are covered by a few ranges, cut at their widest gaps, so a back-dated or
    late number does not stretch one range over the whole table. The ranges are pushed
    into the scan of the lines, where they skip row groups or are run by the source
    database; the join then takes the exact ones.
    """
    lines = src.item_nota_fiscal.withColumnRenamed("id_nota_fiscal", "id_nota")
    if headers is None:
        return lines
    return lines.where(within("id_nota", covering_ranges(headers, "id_nota")))


def _with_day(headers: DataFrame, star: Star) -> DataFrame:
    if star.tempo is None:
        return headers
    calendar = star.tempo.withColumnRenamed("data", STORE_DAY)
    return headers.join(days(calendar, "sk_tempo", STORE_DAY), STORE_DAY, "left")


def _buyers(star: Star, person: str) -> DataFrame:
    """A row per address of a person, and one per customer without an address.

    Written, so that its size is known. A person with very many addresses is on the left
    of both joins, where adaptive execution can split them.
    """
    place = star.localidade.select(F.col("id_pessoa").alias(person), "sk_localidade")
    if star.cliente is None:
        return stage(place, "buyers")
    buyer = star.cliente.select(F.col("id_pessoa").alias(person), "sk_cliente")
    elsewhere = buyer.join(place.select(person).distinct(), person, "left_anti")
    return stage(
        place.join(buyer, person, "left").unionByName(elsewhere, allowMissingColumns=True),
        "buyers",
    )


def _with_buyer(headers: DataFrame, star: Star, rows_per_salt: int) -> DataFrame:
    """Customer and locality keys hang on the same person, so one join adds both."""
    person = "id_cliente"
    if star.localidade is not None:
        return fan_out_join(headers, _buyers(star, person), person, "sk_localidade", rows_per_salt)
    if star.cliente is None:
        return headers
    buyer = star.cliente.select(F.col("id_pessoa").alias(person), "sk_cliente")
    return headers.join(buyer, person, "left")


def _with_seller(headers: DataFrame, star: Star) -> DataFrame:
    if star.vendedor is None:
        return headers
    seller = star.vendedor.select(F.col("id_pessoa").alias("id_vendedor"), "sk_vendedor")
    return headers.join(seller, "id_vendedor", "left")


def _products(src: SalesSource, star: Star) -> DataFrame:
    """List price of every product, with its key where it has a category.

    Written first: the fact then joins a table of known size, and if that join is
    a sort-merge join, it is one between two shuffles. Adaptive execution splits a
    hot product there; it would not if the lookup were itself a join on the product.
    """
    products = src.produto.select(F.col("id").alias("id_produto"), "valor_venda")
    if star.produto is None:
        return products
    keys = star.produto.select("id_produto", "sk_produto")
    return stage(products.join(keys, "id_produto", "left"), "products")


def sales_fact(
    src: SalesSource,
    star: Star,
    first: date | None = None,
    last: date | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Fact rows of the days first..last with a key for each dimension given.

    Day, buyer and seller belong to the invoice, so their keys are joined to the
    invoice headers, which are fewer and narrower than the lines; both list price and
    product key come from one product join. The headers of a few days are written
    first: their size is then known, and where they can be broadcast the lines are not
    shuffled at all.
    """
    sold = invoices(src, first, last)
    headers = _with_seller(
        _with_buyer(_with_day(sold, star), star, rows_per_salt), star
    )
    if first is None or last is None:
        lines = lines_of(src, None)
    else:
        headers = stage(headers, "headers")
        lines = lines_of(src, headers)
    taken_off = discount(F.col("valor_venda"), F.col("valor_unitario"))
    fact = (
        headers.join(lines, "id_nota")
        .join(_products(src, star), "id_produto")
        .withColumn("desconto", taken_off)
        .withColumn("pct_desconto", discount_pct(F.col("desconto"), F.col("valor_unitario")))
    )
    stored = schemas.FATO_VENDA_STORE.names
    return fact.select(*[c for c in stored if c in fact.columns])


def fact_full(src: SalesSource, star: Star, **options) -> DataFrame:
    """All sales, 11 columns."""
    return sales_fact(src, star, **options).select(*schemas.FATO_VENDA.names)


def fact_base(src: SalesSource, star: Star) -> DataFrame:
    """All sales, 10 columns: natural-person buyers and no locality."""
    return sales_fact(src, star).select(*schemas.FATO_VENDA_BASE.names)


def fact_daily(src: SalesSource, star: Star, run_date: date) -> DataFrame:
    """Sales of one day, 11 columns."""
    return sales_fact(src, star, run_date, run_date).select(*schemas.FATO_VENDA.names)


def fact_after_day(
    stored: DataFrame, tempo: DataFrame, run_date: date, new: DataFrame
) -> DataFrame:
    """The stored fact once the rows of a day are replaced by ``new``."""
    day = days(tempo.where(F.col("data") == F.lit(run_date)), "sk_tempo")
    return replace_by_key(stored, "sk_tempo", day, new)
