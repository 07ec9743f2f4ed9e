"""The order/lineitem test tables seen as the transactional sales tables."""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from salesmart.sources.calendar import Calendar
from salesmart.sources.tables import SalesSource

# For queries about sales outside the calendar: those of 1995 fall before it.
SHORT_CALENDAR = Calendar(date(1996, 1, 1), date(2001, 12, 31))

_SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_quantity double, "
        "l_discount double, l_tax double"
    ),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, "
        "p_retailprice double"
    ),
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def sales_source(spark: SparkSession, folder: str) -> SalesSource:
    @cache
    def table(name: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    return SalesSource(spark, {
        "pessoa": lambda: table("customer").selectExpr("c_custkey AS id"),
        "pessoa_fisica": lambda: _natural_persons(table("customer")),
        "pessoa_juridica": lambda: _legal_persons(table("customer")),
        "endereco": lambda: _addresses(table("customer")),
        "bairro": lambda: table("nation").selectExpr(
            "n_nationkey AS id", "concat('B_', n_name) AS descricao",
            "n_nationkey AS id_cidade"),
        "cidade": lambda: table("nation").selectExpr(
            "n_nationkey AS id", "n_name AS descricao", "n_regionkey AS id_estado"),
        "estado": lambda: table("region").selectExpr(
            "r_regionkey AS id", "upper(left(r_name, 2)) AS sigla", "r_name AS descricao"),
        "categoria": lambda: table("part").selectExpr(
            "p_type AS id", "p_type AS descricao").distinct(),
        "produto": lambda: table("part").selectExpr(
            "p_partkey AS id", "p_name AS nome",
            "CASE WHEN p_brand <> 'Brand#2' THEN p_type END AS id_categoria",
            "CAST(p_retailprice AS DECIMAL(18,2)) AS valor_venda"),
        "nota_fiscal": lambda: table("orders").selectExpr(
            "o_orderkey AS id", "o_orderdate AS data_venda",
            "o_custkey AS id_cliente", "o_orderkey % 10 AS id_vendedor"),
        "item_nota_fiscal": lambda: _items(table("lineitem"), table("part")),
        "vendedor_pf": lambda: table("supplier").where("s_suppkey % 7 <> 6").selectExpr(
            "s_suppkey AS id", "s_name AS nome"),
    })


def _natural_persons(customer: DataFrame) -> DataFrame:
    return customer.where("c_mktsegment IN ('HOUSEHOLD', 'BUILDING')").selectExpr(
        "c_custkey AS id", "c_name AS nome",
        "lpad(CAST(c_custkey AS STRING), 11, '0') AS cpf")


def _legal_persons(customer: DataFrame) -> DataFrame:
    registered = (
        "c_mktsegment <> 'HOUSEHOLD' AND NOT (c_mktsegment = 'MACHINERY' AND c_custkey % 5 = 0)"
    )
    return customer.where(registered).selectExpr(
        "c_custkey AS id", "c_name AS razao_social",
        "lpad(CAST(c_custkey AS STRING), 14, '0') AS cnpj")


def _addresses(customer: DataFrame) -> DataFrame:
    """One address per customer, a second for some, none for others; one scan."""
    return (
        customer.where("c_custkey % 13 <> 0")
        .selectExpr(
            "c_custkey",
            "c_nationkey",
            "explode(IF(c_custkey % 10 = 0, array(0, 1), array(0))) AS number",
        )
        .selectExpr(
            "c_custkey * 2 + number AS id",
            "c_custkey AS id_pessoa",
            "IF(c_custkey % 17 = 0, NULL, (c_nationkey + number) % 25) AS id_bairro",
            "lpad(CAST(c_custkey + number * 50000000 AS STRING), 8, '0') AS cep",
        )
    )


def _items(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    price = part.selectExpr(
        "p_partkey AS l_partkey", "CAST(p_retailprice AS DECIMAL(18,2)) AS retail")

    def after(rate: str) -> str:
        share = f"(1 - CAST({rate} AS DECIMAL(4,2)))"
        return f"CAST(round(retail * {share}, 2) AS DECIMAL(18,2))"

    return lineitem.join(price, "l_partkey").selectExpr(
        "l_orderkey AS id_nota_fiscal",
        "l_partkey AS id_produto",
        "CAST(l_quantity AS BIGINT) AS quantidade",
        f"{after('l_discount')} AS valor_unitario",
        f"{after('l_tax')} AS valor_venda_real",
    )
