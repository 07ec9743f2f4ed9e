"""The daily run and the full refresh, end to end."""

from __future__ import annotations

from datetime import date, datetime

import pytest

import __spark_entry__ as entry
from salesmart import schemas
from salesmart.plans import fact as plans_fact
from salesmart.plans import pipeline, quality
from salesmart.plans.pipeline import LOCALITY_MART, MONTH_MART, Warehouse
from salesmart.sinks import tables
from salesmart.sources import testdata
from salesmart.sources.calendar import Calendar, calendar_covering
from tests import edge
from tests.edge import expect, rows
from tests.test_edge_set import FACT_ROWS

RUN_TS = datetime(2024, 2, 8, 6, 30, 15, 987654)
FIRST, LAST = date(2014, 12, 31), date(2024, 2, 7)


@pytest.fixture
def warehouse(tmp_path):
    return Warehouse(str(tmp_path / "warehouse"))


def everything(spark, warehouse):
    """All stored tables of the main mode."""
    star = pipeline.stored_star(spark, warehouse, pipeline.MAIN_DIMENSIONS)
    stored = {
        **star.tables(),
        "fact": pipeline.stored_fact(spark, warehouse),
        "lake": tables.read_table(spark, warehouse.lake, schemas.LAKE),
        "month": tables.read_table(spark, warehouse.table(MONTH_MART), schemas.MART_ANO_MES),
        "locality": tables.read_table(
            spark, warehouse.table(LOCALITY_MART), schemas.MART_LOCALIDADE),
    }
    return {name: rows(df) for name, df in stored.items()}


def test_history_then_rerun(spark, edge_source, warehouse):
    report = pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, first=FIRST)
    assert report.counts == {
        "dim_tempo": 4383, "dim_produto": 2, "dim_cliente": 4, "dim_vendedor": 1,
        "dim_localidade": 5, "fato_venda": 9, "lake": 8,
        "vendas_ano_mes": 2, "vendas_localidade": 4}
    assert "fato_venda: 9 rows" in report.lines()
    before = everything(spark, warehouse)
    assert [r[:-1] for r in before["fact"]] == expect(*FACT_ROWS)
    assert {r[-1] for r in before["month"] + before["locality"]} == {
        datetime(2024, 2, 8, 6, 30, 15)}

    again = pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS)
    assert again.counts["fato_venda"] == 2
    assert everything(spark, warehouse) == before
    stored = pipeline.warehouse_counts(spark, warehouse)
    assert rows(stored.where("table_name = 'fato_venda'")) == [("fato_venda", 9)]


def test_day_by_day_equals_history(spark, edge_source, tmp_path):
    whole, daily = Warehouse(str(tmp_path / "whole")), Warehouse(str(tmp_path / "daily"))
    pipeline.run_pipeline(edge_source, whole, LAST, RUN_TS, first=FIRST)
    days = [
        date(2024, 1, 10), FIRST, date(2024, 2, 5), date(2024, 2, 6), date(2024, 1, 10), LAST]
    for day in days:
        pipeline.run_pipeline(edge_source, daily, day, RUN_TS)
    assert everything(spark, daily) == everything(spark, whole)


def test_keys_survive_new_and_vanished_persons(spark, edge_source, warehouse):
    pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, first=FIRST)
    # Person 5 leaves the source; person 7 buys for the first time.
    invoices = [r for r in edge.ROWS["vendas.nota_fiscal"] if r[0] != 105]
    invoices.append((106, datetime(2024, 2, 8, 10), 7, 6))
    lines = [r for r in edge.ROWS["vendas.item_nota_fiscal"] if r[0] != 105]
    lines.append((106, *edge.ROWS["vendas.item_nota_fiscal"][0][1:]))
    changed = edge.source(spark, nota_fiscal=invoices, item_nota_fiscal=lines)
    pipeline.run_pipeline(changed, warehouse, date(2024, 2, 8), RUN_TS)
    customers = {r[1]: r[0] for r in everything(spark, warehouse)["dim_cliente"]}
    assert customers == {1: 1, 2: 2, 3: 3, 7: 5}

    # Person 5 comes back under the old key, which nobody got meanwhile.
    pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS)
    customers = {r[1]: r[0] for r in everything(spark, warehouse)["dim_cliente"]}
    assert customers == {1: 1, 2: 2, 3: 3, 5: 4}


def test_day_corrected_to_empty(spark, edge_source, warehouse):
    pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, first=FIRST)
    invoices = [r for r in edge.ROWS["vendas.nota_fiscal"] if r[0] != 105]
    corrected = edge.source(spark, nota_fiscal=invoices)
    report = pipeline.run_pipeline(corrected, warehouse, LAST, RUN_TS)
    assert report.counts["fato_venda"] == 0
    assert len(everything(spark, warehouse)["fact"]) == 9
    pipeline.run_pipeline(corrected, warehouse, LAST, RUN_TS, force_clear=True)
    assert len(everything(spark, warehouse)["fact"]) == 7


def test_clearing_days_runs_no_job_per_day(spark, edge_source, warehouse):
    pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, first=FIRST)
    before = len(everything(spark, warehouse)["fact"])
    spark.sparkContext.setJobGroup("clearing", "")
    pipeline.clear_days_without_sales(spark, warehouse, FIRST, LAST, set())
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("clearing")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert before == 9 and not everything(spark, warehouse)["fact"] and len(jobs) <= 4


def test_one_locality(spark, edge_source, warehouse):
    report = pipeline.run_pipeline(
        edge_source, warehouse, LAST, RUN_TS, first=FIRST, one_locality=True)
    assert report.counts["fato_venda"] == 8


def test_run_without_sales_fails_validation(spark, edge_source, warehouse):
    with pytest.raises(quality.ValidationError, match="vendas_ano_mes, vendas_localidade"):
        pipeline.run_pipeline(edge_source, warehouse, date(2024, 3, 1), RUN_TS)


def test_marts_go_to_the_sink(spark, edge_source, warehouse):
    sent = {}
    pipeline.run_pipeline(
        edge_source, warehouse, LAST, RUN_TS, first=FIRST,
        mart_sink=lambda mart, name: sent.update({name: mart.count()}))
    assert sent == {MONTH_MART: 2, LOCALITY_MART: 4}


def test_full_refresh(spark, edge_source, warehouse):
    for _ in range(2):
        report = pipeline.run_full_refresh(edge_source, warehouse, [2023, 2024], RUN_TS)
        assert report.counts == {
            "dim_tempo": 4383, "dim_produto": 2, "dim_cliente": 3, "dim_vendedor": 1,
            "fato_venda": 8, "lake": 7, "vendas_ano_mes": 2}
    month = tables.read_table(spark, warehouse.base.table(MONTH_MART), schemas.MART_ANO_MES)
    assert [r[:-1] for r in rows(month)] == [
        (1, 2024, 1, 4, "39.00", "38.00"), (2, 2024, 2, 8, "54.00", "55.00")]


def test_full_refresh_without_lake_rows_fails(edge_source, warehouse):
    with pytest.raises(ValueError, match="no Parquet rows"):
        pipeline.run_full_refresh(edge_source, warehouse, [2030], RUN_TS)


def test_sale_outside_a_short_calendar_is_replaced_too(spark, edge_source, warehouse):
    short = Calendar(date(2024, 1, 1), date(2024, 2, 6))
    for _ in range(2):
        pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, short, first=FIRST)
    assert len(everything(spark, warehouse)["fact"]) == 9


def test_stored_marts_equal_the_registered_queries(spark, warehouse):
    folder = "/root/testdata/sf0.001"
    source = testdata.sales_source(spark, folder)
    pipeline.run_pipeline(
        source, warehouse, date(2001, 12, 31), RUN_TS,
        calendar_covering(source.nota_fiscal), first=date(1995, 1, 1))
    for mart, query in ((MONTH_MART, "mart_ano_mes"), (LOCALITY_MART, "mart_localidade")):
        stored = pipeline.stored_mart(spark, warehouse, mart).drop("data_atualizacao")
        assert rows(stored) == rows(entry.queries()[query](spark, folder))
    fact = pipeline.stored_fact(spark, warehouse).drop("data_venda")
    assert rows(fact) == rows(plans_fact.fact_full(source, entry._star(source)))


def test_calendar_reaches_the_run_date_and_reports_missing_keys(spark, edge_source, warehouse):
    short = Calendar(date(2024, 1, 1), date(2024, 1, 31))
    report = pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, short, first=FIRST)
    tempo = tables.read_table(spark, warehouse.table("dim_tempo"), schemas.DIM_TEMPO)
    assert tempo.agg({"data": "max"}).first()[0] == date(2024, 12, 31)
    # Only the sale before the calendar has no day key, and the run says so.
    assert report.missing["sk_tempo"] == 1
    assert any("without sk_tempo" in line for line in report.lines())


def test_another_calendar_start_is_refused(spark, edge_source, warehouse):
    pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, first=FIRST)
    before = everything(spark, warehouse)
    with pytest.raises(ValueError, match="begins on 2015-01-01"):
        pipeline.run_pipeline(
            edge_source, warehouse, LAST, RUN_TS, Calendar(date(2014, 1, 1), date(2026, 12, 31)))
    assert everything(spark, warehouse) == before


def test_base_mode_leaves_the_main_tables_alone(spark, edge_source, warehouse):
    pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS, first=FIRST)
    before = everything(spark, warehouse)
    pipeline.run_full_refresh(edge_source, warehouse, [2023, 2024], RUN_TS)
    pipeline.run_pipeline(edge_source, warehouse, LAST, RUN_TS)
    assert everything(spark, warehouse) == before
