"""Warehouse and mart tables over JDBC.

Spark can append to a table or empty it first, but not replace some of its rows. Loaded
facts therefore go to a load table, which each run empties, and one transaction moves them:
it deletes the days that are loaded and inserts the load table's rows. Before it commits
nothing has changed, and afterwards a second run changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schemas import conform
from salesmart.sources.jdbc import Connection

# Rows per insert page.
PAGE_DEFAULT = 2_000
PAGE_FACT = 5_000
PAGE_FACT_BASE = 10_000
PAGE_MART = 1_000

# Connections a write opens unless told otherwise, whatever the number of partitions.
WRITERS = 16


def append_options(
    connection: Connection, table: str, page: int = PAGE_DEFAULT, writers: int = WRITERS
) -> dict[str, str]:
    options = connection.options()
    options.update(dbtable=table, batchsize=str(page), numPartitions=str(writers))
    return options


def refresh_options(
    connection: Connection, table: str, page: int = PAGE_DEFAULT, writers: int = WRITERS
) -> dict[str, str]:
    """Empty the table but keep its definition, then insert."""
    return {**append_options(connection, table, page, writers), "truncate": "true"}


def append(
    df: DataFrame, schema: T.StructType, connection: Connection, table: str,
    page: int = PAGE_DEFAULT, writers: int = WRITERS,
) -> None:
    """Insert in pages; an empty frame inserts nothing."""
    options = append_options(connection, table, page, writers)
    conform(df, schema).write.format("jdbc").mode("append").options(**options).save()


def refresh(
    df: DataFrame, schema: T.StructType, connection: Connection, table: str,
    page: int = PAGE_DEFAULT, writers: int = WRITERS,
) -> None:
    """Full refresh of a table."""
    options = refresh_options(connection, table, page, writers)
    conform(df, schema).write.format("jdbc").mode("overwrite").options(**options).save()


# --- replacing days ----------------------------------------------------------

DAY_KEY = "sk_tempo"


def load_table(table: str) -> str:
    """The table beside ``table`` that a run fills first."""
    return f"{table}_carga"


def replace_days_statements(
    table: str, columns: Sequence[str], cleared: tuple[int, int] | None = None
) -> list[str]:
    """The transaction that replaces the load table's days in ``table``.

    ``cleared`` is a range of day keys that is emptied even where nothing was loaded.
    """
    names = ", ".join(columns)
    loaded = load_table(table)
    statements = [f"DELETE FROM {table} WHERE {DAY_KEY} IN (SELECT {DAY_KEY} FROM {loaded})"]
    if cleared is not None:
        low, high = (int(key) for key in cleared)
        statements.append(f"DELETE FROM {table} WHERE {DAY_KEY} BETWEEN {low} AND {high}")
    return [*statements, f"INSERT INTO {table} ({names}) SELECT {names} FROM {loaded}"]


def replace_all_statements(table: str, columns: Sequence[str]) -> list[str]:
    """The transaction that replaces all rows of ``table``."""
    names = ", ".join(columns)
    return [f"DELETE FROM {table}",
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {load_table(table)}"]


def open_connection(spark: SparkSession, connection: Connection):
    """A connection from the driver process; the driver class may come with --jars."""
    jvm = spark._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    made = loader.loadClass(connection.driver).getDeclaredConstructor([]).newInstance([])
    properties = jvm.java.util.Properties()
    properties.setProperty("user", connection.user)
    properties.setProperty("password", connection.password)
    return made.connect(connection.url, properties)


def in_transaction(connect: Callable[[], object], statements: Sequence[str]) -> None:
    """Run statements as one transaction: all of them or none."""
    session = connect()
    try:
        session.setAutoCommit(False)
        try:
            for text in statements:
                statement = session.createStatement()
                try:
                    statement.executeUpdate(text)
                finally:
                    statement.close()
            session.commit()
        except BaseException:
            session.rollback()
            raise
    finally:
        session.close()


def replace_days(
    df: DataFrame, schema: T.StructType, connection: Connection, table: str,
    page: int = PAGE_FACT, writers: int = WRITERS, cleared: tuple[int, int] | None = None,
) -> None:
    """Replace the days that ``df`` holds. Rows without a day key belong to no day that
    could be replaced, so they are not sent; a run reports how many there are."""
    refresh(df.where(F.col(DAY_KEY).isNotNull()), schema, connection, load_table(table), page, writers)
    in_transaction(lambda: open_connection(df.sparkSession, connection),
                   replace_days_statements(table, schema.names, cleared))


def replace_all(
    df: DataFrame, schema: T.StructType, connection: Connection, table: str,
    page: int = PAGE_FACT_BASE, writers: int = WRITERS,
) -> None:
    """Replace all rows; until the transaction commits, readers see those before."""
    refresh(df, schema, connection, load_table(table), page, writers)
    in_transaction(lambda: open_connection(df.sparkSession, connection),
                   replace_all_statements(table, schema.names))
