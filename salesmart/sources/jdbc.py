"""Source tables over JDBC, read in parallel slices."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salesmart.sources.tables import SOURCE_SCHEMAS, SalesSource, short_name

FETCH_ROWS = 10_000

# Column that splits a large table into slices; the other tables are small.
SLICE_COLUMNS = {
    "geral.pessoa": "id",
    "geral.pessoa_fisica": "id",
    "geral.pessoa_juridica": "id",
    "geral.endereco": "id",
    "vendas.produto": "id",
    "vendas.nota_fiscal": "id",
    "vendas.item_nota_fiscal": "id_nota_fiscal",
}


@dataclass(frozen=True)
class Connection:
    """JDBC address and credentials; the password never enters SQL text."""

    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    def options(self) -> dict[str, str]:
        return {
            "url": self.url, "user": self.user,
            "password": self.password, "driver": self.driver,
        }


@dataclass(frozen=True)
class Slices:
    """Range of a numeric column read as ``count`` concurrent queries."""

    column: str
    lower: int
    upper: int
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def read_options(
    connection: Connection,
    query: str,
    slices: Slices | None = None,
    schema: str | None = None,
) -> dict[str, str]:
    """Options for reading a query; ``query`` may also be a plain table name.

    ``schema`` declares the column types instead of taking the database's.
    """
    text = query.strip()
    options = connection.options()
    options["dbtable"] = f"({text}) q" if " " in text else text
    options["fetchsize"] = str(FETCH_ROWS)
    if slices is not None:
        options.update(slices.options())
    if schema is not None:
        # Wall-clock times stay as they are, whatever the time zone of the JVM.
        options["customSchema"] = re.sub(r"\btimestamp\b", "timestamp_ntz", schema)
        options["preferTimestampNTZ"] = "true"
    return options


def read_sql(
    spark: SparkSession,
    connection: Connection,
    query: str,
    slices: Slices | None = None,
    schema: str | None = None,
) -> DataFrame:
    """The rows of a query over a connection; filters on them run in the database."""
    options = read_options(connection, query, slices, schema)
    return spark.read.format("jdbc").options(**options).load()


def column_range(spark: SparkSession, connection: Connection, table: str, column: str):
    """Smallest and largest value of a column: one row, computed by the database."""
    query = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
    return tuple(read_sql(spark, connection, query).first())


def table_query(table: str) -> str:
    columns = [c.strip().split(" ")[0] for c in SOURCE_SCHEMAS[table].split(", ")]
    return f"SELECT {', '.join(columns)} FROM {table}"


def sales_source(spark: SparkSession, connection: Connection, parallel: int) -> SalesSource:
    """Every source table, the large ones sliced on a key into ``parallel`` reads."""

    def reader(table: str, schema: str) -> Callable[[], DataFrame]:
        return lambda: read_sql(
            spark, connection, table_query(table),
            _slices(spark, connection, table, parallel), schema,
        )

    return SalesSource(spark, {
        short_name(table): reader(table, schema) for table, schema in SOURCE_SCHEMAS.items()
    })


def _slices(
    spark: SparkSession, connection: Connection, table: str, count: int
) -> Slices | None:
    column = SLICE_COLUMNS.get(table)
    if column is None:
        return None
    low, high = column_range(spark, connection, table, column)
    if low is None or low == high:
        return None
    return Slices(column, int(low), int(high), count)
