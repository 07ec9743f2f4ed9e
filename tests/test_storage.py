"""Writers and readers: replacing days, lake partitions, schema checks."""

from __future__ import annotations

import time
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.operators import staging
from salesmart.plans import dims, fact, lake
from salesmart.sinks import tables, versions
from salesmart.sources import tables as source_tables
from salesmart.sources.calendar import Calendar
from salesmart.sources.lake import parse_years, read_lake
from tests.edge import rows

STORE = schemas.FATO_VENDA_STORE


@pytest.fixture(scope="module")
def star(edge_source):
    return dims.star(edge_source, Calendar())


@pytest.fixture(scope="module")
def sales(edge_source, star):
    return fact.sales_fact(edge_source, star)


@pytest.fixture
def store(spark, sales, tmp_path):
    path = str(tmp_path / "fact")
    assert tables.write_fact_full(sales, path, STORE) == 9
    return path


def stored(spark, path):
    return rows(tables.read_table(spark, path, STORE))


def test_fact_store_has_one_folder_per_day(spark, store):
    days = {p.name for p in Path(versions.current(spark, store)).iterdir() if p.is_dir()}
    assert days == {
        "data_venda=2014-12-31", "data_venda=2024-01-10", "data_venda=2024-02-05",
        "data_venda=2024-02-06", "data_venda=2024-02-07"}


def test_reloading_a_day_does_not_duplicate_it(spark, edge_source, star, store):
    before = stored(spark, store)
    for day in (date(2024, 1, 10), date(2014, 12, 31)):
        new = fact.sales_fact(edge_source, star, day, day)
        n, days = tables.replace_fact_days(new, store, STORE)
        assert n > 0 and days == {day}
        assert stored(spark, store) == before


def test_reloading_a_day_removes_what_left_it(spark, edge_source, star, store):
    day = date(2024, 1, 10)
    new = fact.sales_fact(edge_source, star, day, day).where("id_nota = 101")
    assert tables.replace_fact_days(new, store, STORE) == (2, {day})
    left = tables.read_table(spark, store, STORE)
    assert left.count() == 7
    assert left.where("id_nota = 100").count() == 0


def test_a_day_without_sales_leaves_stored_rows(spark, sales, store):
    before = stored(spark, store)
    assert tables.replace_fact_days(sales.where("id_nota < 0"), store, STORE) == (0, set())
    assert stored(spark, store) == before


def test_a_day_can_be_cleared(spark, store):
    tables.drop_fact_days(spark, store, [date(2024, 1, 10)])
    left = tables.read_table(spark, store, STORE)
    assert left.where(F.col("data_venda") == date(2024, 1, 10)).count() == 0
    assert left.count() == 5


def test_month_of_the_fact_store(spark, store):
    february = tables.read_fact_months(spark, store, STORE, date(2024, 2, 20), date(2024, 2, 20))
    whole = tables.read_table(spark, store, STORE)
    assert rows(february) == rows(whole.where("data_venda >= '2024-02-01'"))
    assert tables.read_fact_months(
        spark, store, STORE, date(2024, 3, 1), date(2024, 3, 31)).isEmpty()
    both = tables.read_fact_months(spark, store, STORE, date(2024, 1, 31), date(2024, 2, 1))
    assert rows(both) == rows(whole.where("data_venda >= '2024-01-01'"))


def test_full_refresh_replaces_the_table(spark, star, tmp_path):
    path = str(tmp_path / "dim")
    assert tables.write_full(star.produto, path, schemas.DIM_PRODUTO) == 2
    assert tables.write_full(star.produto.limit(1), path, schemas.DIM_PRODUTO) == 1
    assert tables.read_table(spark, path, schemas.DIM_PRODUTO).count() == 1
    assert tables.read_if_present(spark, path + "/none", schemas.DIM_PRODUTO) is None


def test_appending_nothing_adds_nothing(spark, star, tmp_path):
    path = str(tmp_path / "dim")
    assert tables.append(star.produto, path, schemas.DIM_PRODUTO) == 2
    assert tables.append(star.produto.where("false"), path, schemas.DIM_PRODUTO) == 0
    assert tables.read_table(spark, path, schemas.DIM_PRODUTO).count() == 2


def test_lake_layout_and_round_trip(spark, sales, star, tmp_path):
    path = str(tmp_path / "lake")
    assert tables.write_lake_full(
        lake.lake_base_rows(sales, star.tempo), path, schemas.LAKE_BASE) == 8
    files = [p.relative_to(path) for p in Path(path).rglob("*.parquet")]
    assert {str(f.parent) for f in files} == {"ano=2024/mes=1", "ano=2024/mes=2"}
    assert all(".snappy." in f.name for f in files)
    back = read_lake(spark, path, schemas.LAKE_BASE, [2024])
    assert rows(back) == rows(lake.lake_base_rows(sales, star.tempo))
    assert dict(back.dtypes)["mes"] == "int"


def test_lake_month_is_one_snapshot_however_often_it_is_written(spark, sales, star, tmp_path):
    path = str(tmp_path / "lake")
    for day in (date(2024, 2, 5), date(2024, 2, 6), date(2024, 1, 10), date(2024, 2, 28)):
        month = lake.lake_month_rows(sales, star.tempo, star.localidade, day)
        tables.write_lake_months(month, path, schemas.LAKE)
    assert read_lake(spark, path, schemas.LAKE, [2024]).count() == 8
    empty = lake.lake_month_rows(sales, star.tempo, star.localidade, date(2024, 3, 1))
    assert tables.write_lake_months(empty, path, schemas.LAKE) == 0
    assert read_lake(spark, path, schemas.LAKE, [2024]).count() == 8


def test_lake_years(spark, sales, star, tmp_path):
    path = str(tmp_path / "lake")
    tables.write_lake_full(lake.lake_base_rows(sales, star.tempo), path, schemas.LAKE_BASE)
    (Path(path) / "ano=2024" / "mes=1" / "notes.txt").write_text("not data")
    assert parse_years(" 2023, 2024,2025") == [2023, 2024, 2025]
    assert read_lake(spark, path, schemas.LAKE_BASE, [2023, 2024, 2025]).count() == 8
    with pytest.raises(ValueError, match="2023"):
        read_lake(spark, path, schemas.LAKE_BASE, [2023])
    with pytest.raises(ValueError):
        read_lake(spark, str(tmp_path / "nowhere"), schemas.LAKE_BASE, [2024])


def test_text_over_its_length_fails_the_write(spark, star, tmp_path):
    long = star.localidade.withColumn("cep", F.lit("12345678901"))
    with pytest.raises(Exception, match="cep is longer than 10"):
        tables.write_full(long, str(tmp_path / "d"), schemas.DIM_LOCALIDADE)


def test_discount_over_its_precision_fails_the_write(spark, sales, tmp_path):
    large = sales.withColumn("pct_desconto", F.lit(1000.0))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        tables.write_full(large, str(tmp_path / "f"), schemas.FATO_VENDA)


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame([(float("nan"),), (2.5,)], "x double")
    schema = schemas.T.StructType([schemas.T.StructField("x", schemas.MONEY)])
    assert [r.x if r.x is None else str(r.x) for r in schemas.conform(frame, schema).collect()] == [
        None, "2.50"]


def test_scratch_folder_is_the_configured_one(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging.scratch_folder(spark) == folder
    assert staging.new_folder(spark, "x").startswith(folder)


def test_cluster_without_a_shared_scratch_folder_is_refused():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.scratch_folder(session)
    context.getCheckpointDir = lambda: "hdfs://shared/scratch/"
    assert staging.scratch_folder(session) == "hdfs://shared/scratch"


def test_source_tables_from_parquet(spark, edge_source, tmp_path):
    for table in source_tables.SOURCE_SCHEMAS:
        name = source_tables.short_name(table)
        getattr(edge_source, name).write.parquet(f"{tmp_path}/{name}")
    again = source_tables.from_parquet(spark, str(tmp_path))
    assert rows(again.nota_fiscal) == rows(edge_source.nota_fiscal)
    assert rows(again.sellers) == rows(edge_source.pessoa_fisica)


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    """Not even while the driver has no reason to collect its garbage."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(cleanup), _shuffle_files(spark)
    staged = staging.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    until = time.monotonic() + 10
    while _shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert staged.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(cleanup) == setting
