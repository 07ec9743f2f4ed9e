"""Every registered query against its SQL oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    return check.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert entry._QUERIES.keys() == entry.oracles.oracle_sql().keys()


@pytest.mark.parametrize("name", list(entry._QUERIES))
def test_query_equals_its_oracle(spark, oracle, name):
    result, sql = entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name]
    assert check.spark_types(result) == check.oracle_types(oracle, sql)
    assert check.spark_bag(result) == check.oracle_bag(oracle, sql)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == [
        "id", "ano", "mes", "qtde_vendida", "valor_total_real", "valor_total_esperado"]
    assert result.count() > 0
