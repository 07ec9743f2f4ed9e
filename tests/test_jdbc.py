"""JDBC options; no database is at hand, so the reads and writes are not run."""

from __future__ import annotations

import pytest

from salesmart.sinks import jdbc as sink
from salesmart.sources import jdbc
from salesmart.sources.tables import SOURCE_SCHEMAS

CONNECTION = jdbc.Connection("jdbc:postgresql://host:5432/db", "reader", "secret")


def test_query_is_read_as_a_subquery():
    options = jdbc.read_options(CONNECTION, " SELECT id FROM vendas.produto ")
    assert options["dbtable"] == "(SELECT id FROM vendas.produto) q"
    assert options["url"] == "jdbc:postgresql://host:5432/db"
    assert "numPartitions" not in options and "customSchema" not in options
    assert jdbc.read_options(CONNECTION, "vendas.produto")["dbtable"] == "vendas.produto"


def test_large_tables_are_read_in_slices():
    options = jdbc.read_options(CONNECTION, "t", jdbc.Slices("id", 1, 900, 32))
    assert {k: options[k] for k in (
        "partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "32"}


def test_types_are_declared():
    schema = SOURCE_SCHEMAS["vendas.produto"]
    options = jdbc.read_options(CONNECTION, "vendas.produto", schema=schema)
    assert options["customSchema"] == (
        "id long, nome string, id_categoria long, valor_venda decimal(18,2)")


def test_wall_clock_times_are_read_without_a_zone():
    schema = SOURCE_SCHEMAS["vendas.nota_fiscal"]
    options = jdbc.read_options(CONNECTION, "vendas.nota_fiscal", schema=schema)
    assert "data_venda timestamp_ntz," in options["customSchema"]
    assert options["preferTimestampNTZ"] == "true"


def test_table_queries_name_only_the_columns_used():
    assert jdbc.table_query("geral.endereco") == (
        "SELECT id, id_pessoa, id_bairro, cep FROM geral.endereco")
    assert jdbc.table_query("vendas.produto") == (
        "SELECT id, nome, id_categoria, valor_venda FROM vendas.produto")
    for table, column in jdbc.SLICE_COLUMNS.items():
        assert f"{column} long" in SOURCE_SCHEMAS[table]


def test_refresh_keeps_the_table_definition():
    options = sink.refresh_options(CONNECTION, "public.mart", sink.PAGE_MART)
    assert (options["truncate"], options["batchsize"], options["dbtable"]) == (
        "true", "1000", "public.mart")
    assert options["numPartitions"] == str(sink.WRITERS)


def test_append_pages():
    assert sink.append_options(CONNECTION, "t")["batchsize"] == "2000"
    assert sink.append_options(CONNECTION, "t", sink.PAGE_FACT)["batchsize"] == "5000"
    assert "truncate" not in sink.append_options(CONNECTION, "t")


# --- replacing days ----------------------------------------------------------

class FakeDatabase:
    """Tables of (day key, value) rows that know the statements of the sink."""

    def __init__(self, fail_at=None):
        self.tables = {"f": [(1, "a"), (2, "b"), (3, "c"), (None, "d")], "f_carga": []}
        self.fail_at, self.log = fail_at, []

    def connect(self):
        self.draft = {name: list(rows) for name, rows in self.tables.items()}
        self.closed = False
        return self

    def setAutoCommit(self, on):
        assert on is False

    def createStatement(self):
        return self

    def executeUpdate(self, text):
        if self.fail_at == len(self.log):
            raise RuntimeError("connection lost")
        self.log.append(text)
        loaded = self.draft["f_carga"]
        if text == "DELETE FROM f":
            self.draft["f"] = []
        elif text == "DELETE FROM f WHERE sk_tempo IN (SELECT sk_tempo FROM f_carga)":
            self.draft["f"] = [r for r in self.draft["f"] if r[0] not in {k for k, _ in loaded}]
        elif text.startswith("DELETE FROM f WHERE sk_tempo BETWEEN "):
            low, high = (int(x) for x in text.rsplit("BETWEEN ", 1)[1].split(" AND "))
            self.draft["f"] = [r for r in self.draft["f"] if r[0] is None or not low <= r[0] <= high]
        else:
            assert text == "INSERT INTO f (sk_tempo, v) SELECT sk_tempo, v FROM f_carga"
            self.draft["f"] += loaded

    def commit(self):
        self.tables = self.draft

    def rollback(self):
        self.draft = None

    def close(self):
        self.closed = True


COLUMNS = ["sk_tempo", "v"]


def test_a_second_load_of_a_day_adds_nothing():
    database = FakeDatabase()
    for _ in range(3):
        database.tables["f_carga"] = [(2, "x"), (2, "y"), (4, "z")]
        sink.in_transaction(database.connect, sink.replace_days_statements("f", COLUMNS))
        assert sorted(database.tables["f"], key=str) == [
            (1, "a"), (2, "x"), (2, "y"), (3, "c"), (4, "z"), (None, "d")]


def test_days_corrected_to_empty_are_emptied():
    database = FakeDatabase()
    database.tables["f_carga"] = [(3, "x")]
    sink.in_transaction(database.connect, sink.replace_days_statements("f", COLUMNS, (2, 3)))
    assert sorted(database.tables["f"], key=str) == [(1, "a"), (3, "x"), (None, "d")]


def test_base_mode_empties_the_table_first():
    database = FakeDatabase()
    for _ in range(2):
        database.tables["f_carga"] = [(9, "n")]
        sink.in_transaction(database.connect, sink.replace_all_statements("f", COLUMNS))
        assert database.tables["f"] == [(9, "n")]


@pytest.mark.parametrize("fail_at", [0, 1, 2])
def test_a_lost_connection_changes_nothing(fail_at):
    database = FakeDatabase(fail_at)
    database.tables["f_carga"] = [(2, "x")]
    before = list(database.tables["f"])
    with pytest.raises(RuntimeError, match="connection lost"):
        sink.in_transaction(database.connect, sink.replace_days_statements("f", COLUMNS, (2, 2)))
    assert database.tables["f"] == before and database.closed


def test_loaded_days_go_through_the_load_table(spark, monkeypatch):
    sent, run = [], []
    monkeypatch.setattr(sink, "refresh", lambda df, schema, connection, table, page, writers: sent.append(
        (table, page, df.columns, [r["sk_tempo"] for r in df.collect()])))
    monkeypatch.setattr(sink, "in_transaction", lambda connect, statements: run.append(statements))
    frame = spark.createDataFrame([(1, "a"), (None, "b")], "sk_tempo long, v string")
    sink.replace_days(frame, frame.schema, CONNECTION, "dw.f", cleared=(1, 4))
    assert sent == [("dw.f_carga", 5000, COLUMNS, [1])]
    assert run == [sink.replace_days_statements("dw.f", COLUMNS, (1, 4))]
    sink.replace_all(frame, frame.schema, CONNECTION, "dw.f")
    assert sent[1] == ("dw.f_carga", 10000, COLUMNS, [1, None])
    assert run[1] == sink.replace_all_statements("dw.f", COLUMNS)
