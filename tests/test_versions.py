"""Tables that are replaced in one step."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.plans import dims
from salesmart.sinks import tables, versions
from tests.edge import rows

SCHEMA = schemas.DIM_PRODUTO


@pytest.fixture(scope="module")
def products(edge_source):
    return dims.dim_produto(edge_source)


def held(spark, path):
    return rows(tables.read_table(spark, path, SCHEMA))


def folders(path):
    return sorted(p.name for p in Path(path).iterdir() if not p.name.startswith("."))


def test_a_write_that_dies_leaves_the_table(spark, products, tmp_path):
    path = str(tmp_path / "dim")
    tables.write_full(products, path, SCHEMA)
    before = held(spark, path)
    broken = products.withColumn("nome", F.when(
        F.col("id_produto") > 1, F.raise_error(F.lit("source lost")).cast("string")).otherwise("x"))
    with pytest.raises(Exception, match="source lost"):
        tables.write_full(broken, path, SCHEMA)
    assert held(spark, path) == before


def test_a_run_killed_before_the_commit_leaves_the_table(spark, products, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    tables.write_full(products, path, SCHEMA)
    before = held(spark, path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(versions, "commit", killed)
        tables.write_full(products.limit(1), path, SCHEMA)
    assert held(spark, path) == before and len(folders(path)) == 3
    assert tables.write_full(products.limit(1), path, SCHEMA) == 1
    # What was never committed is gone; the version before stays for its readers.
    assert len(held(spark, path)) == 1 and len(folders(path)) == 3


def test_a_first_write_that_dies_is_no_table(spark, products, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        tables.write_full(products, path, SCHEMA)
    assert tables.read_if_present(spark, path, SCHEMA) is None
    tables.write_full(products, path, SCHEMA)
    assert rows(tables.read_if_present(spark, path, SCHEMA)) == rows(products)


def test_readers_keep_the_version_that_they_began_with(spark, products, tmp_path):
    path = str(tmp_path / "dim")
    tables.write_full(products, path, SCHEMA)
    reader = tables.read_table(spark, path, SCHEMA)
    tables.write_full(products.limit(1), path, SCHEMA)
    assert rows(reader) == rows(products) and len(held(spark, path)) == 1
    for _ in range(3):
        tables.write_full(products.limit(1), path, SCHEMA)
    assert len(folders(path)) == 1 + versions.KEPT
    assert len(list(Path(path, versions.MANIFEST).glob("0*"))) == versions.KEPT


def test_a_table_can_be_rewritten_from_itself(spark, products, tmp_path):
    path = str(tmp_path / "dim")
    tables.write_full(products, path, SCHEMA)
    for _ in range(2):
        own = tables.read_table(spark, path, SCHEMA)
        tables.write_full(own.withColumn("nome", F.concat("nome", F.lit("!"))), path, SCHEMA)
    assert {r[2][-2:] for r in held(spark, path)} == {"!!"}


def test_a_plain_table_becomes_a_versioned_one(spark, products, tmp_path):
    path = str(tmp_path / "dim")
    tables.append(products, path, SCHEMA)
    assert held(spark, path) == rows(products) and versions.current(spark, path) == path
    tables.write_full(products.limit(1), path, SCHEMA)
    assert len(held(spark, path)) == 1
    assert all(name == versions.MANIFEST or name.startswith("data-") for name in folders(path))


def test_two_runs_cannot_commit_one_version(spark, products, tmp_path):
    path = str(tmp_path / "dim")
    tables.write_full(products, path, SCHEMA)
    (one, number), (two, same) = (versions.next_version(spark, path) for _ in range(2))
    assert number == same == 2
    for folder in (one, two):
        products.limit(1).write.parquet(folder)
    versions.commit(spark, path, one, number)
    with pytest.raises(versions.ConflictError, match="version 2"):
        versions.commit(spark, path, two, same)
    assert versions.current(spark, path) == one
