"""Every table and dataset on the hand-made source rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.plans import dashboard, dims, fact, lake, marts, quality
from salesmart.sources.calendar import Calendar, dim_tempo
from tests.edge import expect, rows


@pytest.fixture(scope="module")
def star(edge_source):
    return dims.star(edge_source, Calendar())


@pytest.fixture(scope="module")
def sales(edge_source, star):
    return fact.sales_fact(edge_source, star).cache()


@pytest.fixture(scope="module")
def monthly(sales, star):
    return marts.monthly_sales(sales, star.tempo).cache()


@pytest.fixture(scope="module")
def locality(sales, star):
    return marts.locality_sales(sales, star.tempo, star.localidade).cache()


def test_calendar(star):
    assert star.tempo.count() == 4383
    assert star.tempo.columns == schemas.DIM_TEMPO.names
    day = star.tempo.where(F.col("data") == date(2024, 1, 10)).first()
    assert tuple(day) == (
        3297, date(2024, 1, 10), 2024, 1, 1, "January", "Wednesday", False)
    saturday = star.tempo.where(F.col("data") == date(2024, 5, 4)).first()
    assert (saturday.nome_mes, saturday.dia_semana, saturday.is_fim_semana) == (
        "May", "Saturday", True)


def test_calendar_bounds_are_parameters(spark):
    days = dim_tempo(spark, Calendar(date(2030, 12, 31), date(2031, 1, 2)))
    assert [(r.sk_tempo, r.ano, r.trimestre) for r in days.orderBy("data").collect()] == [
        (1, 2030, 4), (2, 2031, 1), (3, 2031, 1)]


def test_dimensions(star):
    assert rows(star.produto) == expect(
        (1, 1, "Caneta", "Papelaria", "10.00"), (2, 2, "Caderno", "Papelaria", "25.00"))
    assert rows(star.vendedor) == expect((1, 6, "Vera"))
    assert rows(star.cliente) == expect(
        (1, 1, "Ana", "111", "PF"), (2, 2, "Bruno", "222", "PF"),
        (3, 3, "Acme", "333", "PJ"), (4, 5, "Cinco Ltda", "555", "PF"))
    assert rows(star.localidade) == expect(
        (1, 1, "Centro", "Santos", "SP", "Sao Paulo", "11000"),
        (2, 2, "Sul", "Bom Jesus", "SP", "Sao Paulo", "12000"),
        (3, 2, "Icarai", "Niteroi", "RJ", "Rio de Janeiro", "24000"),
        (4, 3, None, None, None, None, "00000"),
        (5, 5, "Norte", "Bom Jesus", "RJ", "Rio de Janeiro", "28000"))
    for name, schema in [
        ("produto", schemas.DIM_PRODUTO), ("cliente", schemas.DIM_CLIENTE),
        ("vendedor", schemas.DIM_VENDEDOR), ("localidade", schemas.DIM_LOCALIDADE),
    ]:
        assert getattr(star, name).columns == schema.names


def test_natural_person_buyers(edge_source):
    assert rows(dims.dim_cliente_pf(edge_source)) == expect(
        (1, 1, "Ana", "111"), (2, 2, "Bruno", "222"), (3, 5, None, "555"))


FACT_ROWS = [
    (3297, 1, 1, 1, 1, 100, 2, "10.00", "9.00", "0.00", "0.00"),
    (3297, 2, 1, 1, 1, 100, 1, "20.00", "22.00", "5.00", "25.00"),
    (3297, 1, 2, 1, 2, 101, 1, "8.00", "8.00", "2.00", "25.00"),
    (3297, 1, 2, 1, 3, 101, 1, "8.00", "8.00", "2.00", "25.00"),
    (3323, 2, 3, 1, 4, 102, 5, "25.00", "20.00", "0.00", "0.00"),
    (3324, 1, None, None, None, 103, 1, "0.00", "5.00", "10.00", None),
    (None, 1, 1, 1, 1, 104, 1, "10.00", "10.00", "0.00", "0.00"),
    (3325, 2, 4, None, 5, 105, 1, "25.00", "24.00", "0.00", "0.00"),
    (3325, None, 4, None, 5, 105, 1, "5.00", "5.00", "0.00", "0.00"),
]


def test_fact_full(edge_source, star):
    full = fact.fact_full(edge_source, star)
    assert full.columns == schemas.FATO_VENDA.names
    assert rows(full) == expect(*FACT_ROWS)


def test_fact_with_every_key_treated_as_hot(edge_source, star):
    salted = fact.fact_full(edge_source, star, rows_per_salt=1)
    assert rows(salted) == expect(*FACT_ROWS)


def test_fact_one_locality(edge_source, star):
    full = fact.fact_full(edge_source, dims.with_one_locality(star))
    assert rows(full) == expect(*[r for r in FACT_ROWS if r[4] != 3])


def test_fact_base(edge_source):
    base = fact.fact_base(edge_source, dims.base_star(edge_source, Calendar()))
    assert base.columns == schemas.FATO_VENDA_BASE.names
    assert rows(base) == expect(
        (3297, 1, 1, 1, 100, 2, "10.00", "9.00", "0.00", "0.00"),
        (3297, 2, 1, 1, 100, 1, "20.00", "22.00", "5.00", "25.00"),
        (3297, 1, 2, 1, 101, 1, "8.00", "8.00", "2.00", "25.00"),
        (3323, 2, None, 1, 102, 5, "25.00", "20.00", "0.00", "0.00"),
        (3324, 1, None, None, 103, 1, "0.00", "5.00", "10.00", None),
        (None, 1, 1, 1, 104, 1, "10.00", "10.00", "0.00", "0.00"),
        (3325, 2, 3, None, 105, 1, "25.00", "24.00", "0.00", "0.00"),
        (3325, None, 3, None, 105, 1, "5.00", "5.00", "0.00", "0.00"))


def test_day_includes_its_last_second(edge_source, star):
    day = fact.fact_daily(edge_source, star, date(2024, 1, 10))
    assert rows(day) == expect(*FACT_ROWS[:4])
    assert fact.fact_daily(edge_source, star, date(2024, 1, 11)).count() == 0


def test_full_fact_is_the_union_of_its_days(edge_source, star):
    dates = [r[0].date() for r in edge_source.nota_fiscal.select("data_venda").collect()]
    days = [rows(fact.fact_daily(edge_source, star, d)) for d in set(dates)]
    assert expect(*[r for day in days for r in day]) == expect(*FACT_ROWS)


def test_replacing_a_day_twice_changes_nothing(edge_source, star):
    full = fact.fact_full(edge_source, star)
    day = date(2024, 1, 10)
    new = fact.fact_daily(edge_source, star, day)
    once = fact.fact_after_day(full, star.tempo, day, new)
    assert rows(once) == expect(*FACT_ROWS)
    twice = fact.fact_after_day(once, star.tempo, day, new)
    assert rows(twice) == expect(*FACT_ROWS)


def test_replacing_a_day_drops_what_is_no_longer_sold(edge_source, star):
    full = fact.fact_full(edge_source, star)
    day = date(2024, 1, 10)
    new = fact.fact_daily(edge_source, star, day).where("id_nota = 100")
    kept = [r for r in FACT_ROWS if r[5] != 101]
    assert rows(fact.fact_after_day(full, star.tempo, day, new)) == expect(*kept)


def test_month_mart(monthly):
    assert rows(marts.mart_ano_mes(monthly)) == expect(
        (1, 2024, 1, 5, "47.00", "46.00"), (2, 2024, 2, 8, "54.00", "55.00"))


def test_locality_mart(locality):
    assert rows(marts.mart_localidade(locality)) == expect(
        (1, 2024, "RJ", "Rio de Janeiro", "Bom Jesus", 2, "29.00", "30.00", "96.67"),
        (2, 2024, "RJ", "Rio de Janeiro", "Niteroi", 1, "8.00", "8.00", "100.00"),
        (3, 2024, "SP", "Sao Paulo", "Bom Jesus", 1, "8.00", "8.00", "100.00"),
        (4, 2024, "SP", "Sao Paulo", "Santos", 3, "31.00", "30.00", "103.33"))


def test_lake_rows(sales, star):
    assert lake.lake_base_rows(sales, star.tempo).count() == 8
    month = lake.lake_month_rows(sales, star.tempo, star.localidade, date(2024, 2, 20))
    assert rows(month) == expect(
        (date(2024, 2, 5), 5, "25.00", "20.00", None, None, 2024, 2),
        (date(2024, 2, 6), 1, "0.00", "5.00", None, None, 2024, 2),
        (date(2024, 2, 7), 1, "25.00", "24.00", "RJ", "Bom Jesus", 2024, 2),
        (date(2024, 2, 7), 1, "5.00", "5.00", "RJ", "Bom Jesus", 2024, 2))


def test_revenue_by_state(sales, star):
    table = marts.revenue_by_state(sales, star.tempo, star.localidade)
    assert [(r.sigla_estado, str(r.faturamento)) for r in table.collect()] == [
        ("SP", "39.00"), ("RJ", "37.00"), (None, "20.00")]


def test_years(monthly):
    assert [tuple(r) for r in dashboard.years(monthly).collect()] == [(2024, True)]


def test_kpis(monthly):
    row = dashboard.kpis(monthly, 2024).first()
    assert (str(row.receita_real), str(row.receita_esperada), row.qtde_vendida) == (
        "101.00", "101.00", 13)
    assert (str(row.desvio), row.pct_atingimento) == ("0.00", 100.0)
    assert row.ticket_medio == pytest.approx(101 / 13)
    assert (row.melhor_mes, str(row.melhor_valor)) == ("Fev", "54.00")


def test_kpi_cards(monthly):
    cards = dashboard.kpi_cards(monthly, 2024).orderBy("ordem").collect()
    assert [tuple(c)[1:] for c in cards] == [
        ("Receita Real", "R$ 101.00", "▲ R$ 0.00 vs meta", "green", "orange"),
        ("Meta Esperada", "R$ 101.00", "acumulado anual", "muted", "orange"),
        ("Qtde Vendida", "13", "ticket médio R$ 7.77", "muted", "orange"),
        ("Atingimento", "100.0%", "acima da meta", "green", "green"),
        ("Melhor Mês", "Fev", "R$ 54.00", "muted", "orange")]


def test_kpis_of_a_year_without_target(spark):
    months = spark.createDataFrame(
        [(2024, 3, 0, 5, 0), (2024, 1, 0, 5, 0)],
        "ano int, mes int, qtde_vendida long, valor_total_real int, valor_total_esperado int",
    ).selectExpr(
        "ano", "mes", "qtde_vendida",
        "cast(valor_total_real as decimal(18,2)) as valor_total_real",
        "cast(valor_total_esperado as decimal(18,2)) as valor_total_esperado")
    row = dashboard.kpis(months, 2024).first()
    assert (row.pct_atingimento, row.ticket_medio, row.melhor_mes) == (0.0, 0.0, "Jan")
    charts = dashboard.monthly_charts(
        months.withColumn("id", F.lit(1)), 2024).collect()
    assert [(c.pct_ating, c.faixa_ating, c.rotulo_ating) for c in charts] == [
        (None, "red", None)] * 2


def test_monthly_charts(monthly):
    charts = dashboard.monthly_charts(marts.mart_ano_mes(monthly), 2024).collect()
    assert [
        (c.nome_mes, str(c.desvio), c.pct_ating, c.faixa_ating, c.rotulo_ating,
         c.faixa_desvio, c.rotulo_desvio) for c in charts
    ] == [
        ("Jan", "1.00", 102.2, "green", "102%", "green", "R$ 1.00"),
        ("Fev", "-1.00", 98.2, "yellow", "98%", "red", "R$ -1.00")]


def test_locality_charts(locality):
    states = dashboard.state_top10(locality, 2024).collect()
    assert [(s["rank"], s.sigla_estado, str(s.valor_total_real), s.pct, s.rotulo) for s in states] == [
        (1, "SP", "39.00", 102.6, "R$ 39.00  (103%)"),
        (2, "RJ", "37.00", 97.4, "R$ 37.00  (97%)")]
    cities = dashboard.city_top20(locality, 2024).collect()
    assert [(c["rank"], c.cidade, str(c.valor_total_real), str(c.valor_total_esperado))
            for c in cities] == [
        (1, "Bom Jesus", "37.00", "38.00"), (2, "Santos", "31.00", "30.00"),
        (3, "Niteroi", "8.00", "8.00")]
    table = dashboard.locality_table(locality, 2024).collect()
    assert [(r.sigla_estado, r.cidade) for r in table] == [
        ("RJ", "Bom Jesus"), ("RJ", "Niteroi"), ("SP", "Bom Jesus"), ("SP", "Santos")]
    assert dashboard.locality_table(locality, 2023).count() == 0


def test_quality(sales, star, monthly, locality):
    assert quality.null_keys(sales).first().asDict() == {
        "sk_tempo": 1, "sk_produto": 1, "sk_cliente": 1, "sk_vendedor": 3,
        "sk_localidade": 1}
    assert rows(quality.referential_integrity(sales, star)) == expect(*[
        (f"dim_{name}", 0, 0) for name in quality.KEYS])
    counts = quality.row_counts({"fato_venda": sales, **star.tables()})
    assert rows(counts) == expect(
        ("fato_venda", 9), ("dim_tempo", 4383), ("dim_produto", 2), ("dim_cliente", 4),
        ("dim_vendedor", 1), ("dim_localidade", 5))
    lines = quality.reconciliation(sales, star, monthly, locality)
    assert {r.item: str(r.valor_real) for r in lines.collect()} == {
        "fact": "111.00", "outside_calendar": "10.00", "unexplained_month": "0.00",
        "month_mart": "101.00", "no_locality": "5.00", "incomplete_locality": "20.00",
        "unexplained_locality": "0.00", "locality_mart": "76.00"}


def test_reconciliation_reports_a_stale_mart(sales, star, monthly, locality):
    stale = quality.reconciliation(sales, star, monthly.where("mes = 2"), locality)
    found = {r.item: str(r.valor_real) for r in stale.collect()}
    assert (found["unexplained_month"], found["unexplained_locality"]) == ("47.00", "-47.00")


def test_orphans_are_found(sales, star):
    partial = dims.replace(star, produto=star.produto.where("sk_produto = 1"))
    found = {r.dimension: (r.orphan_keys, r.orphan_rows)
             for r in quality.referential_integrity(sales, partial).collect()}
    assert found["dim_produto"] == (1, 3)
    assert found["dim_cliente"] == (0, 0)


def test_validation_lists_every_empty_table():
    full = dict.fromkeys(quality.REQUIRED_TABLES, 1)
    quality.validate(full)
    with pytest.raises(quality.ValidationError, match="dim_cliente, vendas_ano_mes"):
        quality.validate({**full, "dim_cliente": 0, "vendas_ano_mes": 0})
