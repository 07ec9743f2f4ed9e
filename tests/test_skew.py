"""One key with a third of all rows, on every side of every join."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from salesmart.operators.lookup import fan_out_join
from salesmart.plans import dims, fact, marts
from salesmart.sources.calendar import Calendar
from tests import edge
from tests.test_plans import plan_of, settings

LINES, INVOICES, PERSONS = 9000, 1500, 300

SMALL_PARTITIONS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.2",
    "spark__sql__shuffle__partitions": "8",
}


def third(i: int, hot: int, other: int) -> int:
    return hot if i % 3 == 0 else other


def skewed_source(spark):
    """Hot buyer, seller-less third, hot invoice, hot product, hot address owner."""
    price = [Decimal(10 + i % 40) for i in range(LINES)]
    return edge.source(
        spark,
        pessoa=[(i,) for i in range(PERSONS)],
        pessoa_fisica=[(i, f"P{i}", str(i)) for i in range(0, PERSONS, 2)],
        pessoa_juridica=[(i, f"J{i}", str(i)) for i in range(0, PERSONS, 3)],
        endereco=[
            (i, third(i, 7, i % PERSONS), 1 + i % 4, f"{i:05d}") for i in range(600)],
        nota_fiscal=[
            (i, datetime(2024, 1, 1) + timedelta(hours=i),
             third(i, 11, i % PERSONS), None if i % 3 == 1 else i % PERSONS)
            for i in range(INVOICES)],
        item_nota_fiscal=[
            (third(i, 5, i % INVOICES), third(i // 3, 2, 1 + i % 3), 1 + i % 9,
             price[i], price[i] - Decimal("0.50"))
            for i in range(LINES)],
    )


@pytest.fixture(scope="module")
def source(spark):
    return skewed_source(spark)


@pytest.fixture(scope="module")
def star(source):
    return dims.star(source, Calendar())


@pytest.fixture(scope="module")
def expected(source, star):
    """Row count and checksums of the fact, joined by brute force in another engine."""
    connection = duckdb.connect()
    frames = {
        "nota": source.nota_fiscal, "item": source.item_nota_fiscal,
        "produto": source.produto, "local": star.localidade, "cliente": star.cliente,
    }
    for name, frame in frames.items():
        connection.register(name, frame.toPandas())
    return connection.execute("""
        SELECT count(*), sum(quantidade)::BIGINT, sum(sk_localidade)::BIGINT,
               sum(sk_cliente)::BIGINT, count(id_vendedor)
        FROM item JOIN nota ON nota.id = id_nota_fiscal
        JOIN produto ON produto.id = id_produto
        LEFT JOIN local ON local.id_pessoa = id_cliente
        LEFT JOIN cliente ON cliente.id_pessoa = id_cliente""").fetchone()


def summary(facts):
    return tuple(facts.agg(
        F.count(F.lit(1)), F.sum("quantidade"), F.sum("sk_localidade"), F.sum("sk_cliente"),
    ).first())


def test_skewed_fact_is_whole(spark, source, star, expected):
    assert summary(fact.sales_fact(source, star)) == expected[:4]
    with settings(spark, **SMALL_PARTITIONS):
        assert summary(fact.sales_fact(source, star)) == expected[:4]
        assert summary(fact.sales_fact(source, star, rows_per_salt=20)) == expected[:4]


def test_adaptive_execution_splits_the_hot_keys(spark, source, star, expected):
    with settings(spark, **SMALL_PARTITIONS):
        facts = fact.sales_fact(source, star)
        assert len(facts.collect()) == expected[0]
        plan = plan_of(facts)
        split = re.findall(r"Join\(skew=true\).*\nLeft keys \[\d\]: \[(\w+)#", plan)
        assert set(split) >= {"id_cliente", "id_vendedor", "id_nota", "id_produto"}
        assert "FullOuter" not in plan


def test_hot_lookup_key_is_spread_over_salts(spark):
    # Key 1 owns 400 of 1,200 lookup rows, and a third of the rows that look it up.
    rows = spark.range(0, 90).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id"))
        .alias("k"), F.col("id").alias("row"))
    lookup = spark.range(0, 1200).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2).alias("k"),
        F.col("id").alias("sk"))
    plain = rows.join(lookup, "k", "left")
    for size in (1, 50, 399, 400, 10**6):
        salted = fan_out_join(rows, lookup, "k", "sk", size)
        assert salted.columns == plain.columns
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
    # One plan for all sizes: how many salts a key has is data.
    plans = {
        size: re.sub(r"#\d+L?|\[plan_id=\d+\]|file:[^\],]*|\d+", "",
                     plan_of(fan_out_join(rows, lookup, "k", "sk", size), "simple"))
        for size in (50, 10**6)}
    assert plans[50] == plans[10**6] and "_salt" in plans[50]


def test_marts_of_skewed_sales(spark, source, star):
    facts = fact.sales_fact(source, star)
    plain = (
        facts.join(star.tempo, "sk_tempo").join(star.localidade, "sk_localidade")
        .groupBy("ano", "sigla_estado", "estado", "cidade")
        .agg(F.sum("quantidade").alias("qtde_vendida")))
    mart = marts.locality_sales(facts, star.tempo, star.localidade)
    assert edge.rows(mart.select(plain.columns)) == edge.rows(plain)
