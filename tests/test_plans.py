"""The physical plans: what is pushed down, pruned, split and kept off one task."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from salesmart import schemas
from salesmart.operators.ranking import top_ranked
from salesmart.plans import dims, eager, fact, lake, marts
from salesmart.sinks import tables
from salesmart.sources import testdata
from salesmart.sources.lake import read_lake

FOLDER = "/root/testdata/sf0.001"


def plan_of(df, mode="formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **changed):
    keys = {name.replace("__", "."): value for name, value in changed.items()}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in keys:
            spark.conf.unset(key)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def source(spark):
    return testdata.sales_source(spark, FOLDER)


@pytest.fixture(scope="module")
def star(source):
    return dims.star(source, testdata.SHORT_CALENDAR)


@pytest.fixture(scope="module")
def stored(spark, source, star, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "fact")
    tables.write_fact_full(fact.sales_fact(source, star), path, schemas.FATO_VENDA_STORE)
    return tables.read_table(spark, path, schemas.FATO_VENDA_STORE)


@pytest.mark.parametrize("name", list(entry._QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    for forbidden in ("CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert forbidden not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.fixture(scope="module")
def busy_day(source) -> date:
    return source.nota_fiscal.select("data_venda").first().data_venda.date()


def test_day_filter_reaches_the_scan(source, star, busy_day):
    plan = plan_of(fact.invoices(source, busy_day, busy_day))
    assert re.search(
        rf"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,{busy_day}.*"
        rf"LessThan\(o_orderdate,{busy_day + timedelta(days=1)}", plan)


def test_invoice_numbers_of_the_day_reach_the_scan_of_the_lines(source, star, busy_day):
    plan = plan_of(fact.fact_daily(source, star, busy_day))
    assert re.search(
        r"PushedFilters: \[.*GreaterThanOrEqual\(l_orderkey,\d+.*LessThanOrEqual\(l_orderkey,",
        plan)


def test_lines_of_a_day_are_not_shuffled(source, star, busy_day):
    plan = plan_of(fact.fact_daily(source, star, busy_day), "simple")
    assert "lineitem" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("build", [entry._monthly, entry._locality])
def test_the_year_reaches_the_scans(source, build, monkeypatch):
    """The headers of a year are written first, from a scan with its bounds."""
    plans = []
    monkeypatch.setattr(eager, "stage", lambda df, name: plans.append(plan_of(df)) or df)
    build(source, 2000)
    assert any(re.search(
        r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,2000-01-01.*"
        r"LessThan\(o_orderdate,2001-01-01", plan) for plan in plans)


def test_a_day_without_invoices_does_not_read_the_lines(source, star):
    plan = plan_of(fact.fact_daily(source, star, date(2030, 1, 1)), "simple")
    assert "lineitem" not in plan


def test_scans_read_only_the_columns_used(source):
    plan = plan_of(marts.monthly_sales(
        fact.sales_fact(source, dims.Star(tempo=entry._tempo(source))), entry._tempo(source)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "p_name" not in plan


def test_lake_reads_only_the_years_asked_for(spark, source, tmp_path):
    star = dims.Star(tempo=entry._tempo(source))
    path = str(tmp_path / "lake")
    tables.write_lake_full(
        lake.lake_base_rows(fact.sales_fact(source, star), star.tempo), path, schemas.LAKE_BASE)
    plan = plan_of(read_lake(spark, path, schemas.LAKE_BASE, [1999, 2000]))
    assert re.search(r"PartitionFilters: \[.*ano#\d+ IN \(1999,2000\)", plan)


def test_lake_month_reads_only_its_days(stored, star):
    plan = plan_of(lake.lake_month_rows(stored, star.tempo, star.localidade, date(1998, 10, 3)))
    assert re.search(r"PartitionFilters: .*data_venda#\d+ >= 1998-10-01.*<= 1998-10-31", plan)


def test_locality_sums_before_it_shuffles(stored, star, spark):
    with settings(spark, **NO_BROADCAST):
        plan = plan_of(marts.locality_sales(stored, star.tempo, star.localidade), "simple")
    above = plan[:plan.index("data_venda")]
    assert above.rindex("partial_sum(quantidade") > above.rindex("+- Exchange")


def test_fact_is_never_shuffled_by_day(stored, star, spark):
    with settings(spark, **NO_BROADCAST):
        plans = [
            marts.monthly_sales(stored, star.tempo),
            marts.locality_sales(stored, star.tempo, star.localidade),
            marts.revenue_by_state(stored, star.tempo, star.localidade),
            lake.lake_base_rows(stored, star.tempo),
            lake.lake_month_rows(stored, star.tempo, star.localidade, date(1998, 10, 3)),
        ]
        assert not any("hashpartitioning(sk_tempo" in plan_of(p, "simple") for p in plans)


def test_partial_aggregation_precedes_the_distinct_of_invoiced_persons(source, spark):
    with settings(spark, **NO_BROADCAST):
        plan = plan_of(dims.cliente_rows(source), "simple")
    assert re.search(
        r"HashAggregate\(keys=\[(id#\d+)L\].*\n.*Exchange hashpartitioning\(\1L.*\n"
        r".*HashAggregate\(keys=\[\1L\].*\n.*o_custkey", plan)


def test_top_k_is_a_bounded_sort(spark):
    frame = spark.range(1000).select((F.col("id") % 50).alias("v"), F.col("id").alias("k"))
    assert "TakeOrderedAndProject" in plan_of(top_ranked(frame, 10, "v", "k"), "simple")


def test_top_k_limit_and_ties(spark):
    frame = spark.createDataFrame(
        [("d", 5), ("a", 5), ("c", 9), ("b", 5), ("e", 1)], "k string, v int")
    assert [(r["rank"], r.k) for r in top_ranked(frame, 3, "v", "k").collect()] == [
        (1, "c"), (2, "a"), (3, "b")]


def test_small_stored_dimensions_are_broadcast_by_their_size(source, star, spark):
    assert "SortMergeJoin [id_cliente" not in plan_of(fact.sales_fact(source, dims.Star(
        tempo=star.tempo, localidade=star.localidade)), "simple")
    with settings(spark, **NO_BROADCAST):
        plan = plan_of(fact.sales_fact(source, star), "simple")
    assert re.findall(r"BroadcastHashJoin \[(\w+)#", plan) == ["data_venda"]


def test_key_windows_never_see_the_whole_dimension(source, spark):
    for build in (dims.dim_cliente, dims.dim_localidade, dims.dim_produto):
        plan = plan_of(build(source), "simple")
        assert "Window" not in plan and "SinglePartition" not in plan
