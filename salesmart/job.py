"""Command line for spark-submit: daily run, full refresh, dashboard datasets.

    spark-submit --py-files salesmart.zip salesmart/job.py \\
        daily --source <folder> --warehouse <folder> --run-date 2024-02-07
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from salesmart import schemas
from salesmart.operators import staging
from salesmart.plans import dashboard, pipeline
from salesmart.plans.pipeline import LOCALITY_MART, MART_SCHEMAS, MONTH_MART, Warehouse
from salesmart.session import cluster_session
from salesmart.sinks import jdbc as jdbc_sink
from salesmart.sinks import lease
from salesmart.sources import jdbc, tables
from salesmart.sources.calendar import Calendar
from salesmart.sources.lake import parse_years

# Fixed value: the years of the base-mode mart when none are given.
DEFAULT_YEARS = "2024,2025,2026"


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="salesmart")
    modes = parser.add_subparsers(dest="mode", required=True)

    stored = argparse.ArgumentParser(add_help=False)
    stored.add_argument("--warehouse", required=True, help="folder of the stored tables")
    stored.add_argument("--lake", help="folder of the lake, if not in the warehouse")

    load = argparse.ArgumentParser(add_help=False)
    source = load.add_mutually_exclusive_group(required=True)
    source.add_argument("--source", help="folder with one Parquet table per source table")
    source.add_argument("--source-jdbc", help="JDBC URL of the source database")
    load.add_argument("--source-user")
    load.add_argument("--source-password-file")
    load.add_argument("--source-readers", type=int, default=64)
    load.add_argument("--mart-jdbc", help="JDBC URL that the marts are also written to")
    load.add_argument("--mart-user")
    load.add_argument("--mart-password-file")
    load.add_argument("--fact-table", help="table there whose loaded days are replaced")
    load.add_argument("--mart-writers", type=int, default=jdbc_sink.WRITERS,
                      help="connections that a mart is written over")
    load.add_argument("--lease-hours", type=float, default=lease.EXPIRY / 3600,
                      help="after which another run may take over from a dead one")
    load.add_argument("--calendar-first", type=date.fromisoformat, default=Calendar().first)
    load.add_argument("--calendar-last", type=date.fromisoformat, default=Calendar().last)

    daily = modes.add_parser("daily", parents=[stored, load], help="load one day")
    daily.add_argument("--run-date", type=date.fromisoformat, required=True)
    daily.add_argument("--first", type=date.fromisoformat, help="load first..run-date")
    daily.add_argument("--one-locality", action="store_true")
    daily.add_argument("--force-clear", action="store_true")

    refresh = modes.add_parser("refresh", parents=[stored, load], help="base mode, all sales")
    refresh.add_argument("--years", type=parse_years, default=parse_years(DEFAULT_YEARS))

    show = modes.add_parser("dashboard", parents=[stored], help="print a year's datasets")
    show.add_argument("--year", type=int, help="latest year by default")
    return parser


def _connection(url: str, user: str, password_file: str) -> jdbc.Connection:
    with open(password_file, encoding="utf-8") as file:
        return jdbc.Connection(url, user, file.read().strip())


def _source(spark: SparkSession, args: argparse.Namespace) -> tables.SalesSource:
    if args.source:
        return tables.from_parquet(spark, args.source)
    connection = _connection(args.source_jdbc, args.source_user, args.source_password_file)
    return jdbc.sales_source(spark, connection, args.source_readers)


def _send_mart(
    connection: jdbc.Connection, writers: int, mart: DataFrame, name: str
) -> None:
    jdbc_sink.refresh(
        mart, MART_SCHEMAS[name], connection, name, jdbc_sink.PAGE_MART, writers)


def _mart_sink(args: argparse.Namespace) -> pipeline.MartSink | None:
    if not args.mart_jdbc:
        return None
    connection = _connection(args.mart_jdbc, args.mart_user, args.mart_password_file)
    return partial(_send_mart, connection, args.mart_writers)


def _send_days(
    connection: jdbc.Connection, table: str, writers: int, rows: DataFrame,
    cleared: tuple[int, int] | None,
) -> None:
    jdbc_sink.replace_days(
        rows, schemas.FATO_VENDA, connection, table, jdbc_sink.PAGE_FACT, writers, cleared)


def _send_all(
    connection: jdbc.Connection, table: str, writers: int, rows: DataFrame,
    cleared: tuple[int, int] | None,
) -> None:
    jdbc_sink.replace_all(
        rows, schemas.FATO_VENDA_BASE, connection, table, jdbc_sink.PAGE_FACT_BASE, writers)


def _fact_sink(args: argparse.Namespace) -> pipeline.FactSink | None:
    """The loaded days are replaced in a table of the mart database, if one is named; the
    base mode replaces all its rows."""
    if not args.fact_table:
        return None
    connection = _connection(args.mart_jdbc, args.mart_user, args.mart_password_file)
    send = _send_all if args.mode == "refresh" else _send_days
    return partial(send, connection, args.fact_table, args.mart_writers)


def _checked(parser: argparse.ArgumentParser, argv: Sequence[str] | None) -> argparse.Namespace:
    """Arguments, refused where an address lacks its user or a table its address."""
    args = parser.parse_args(argv)
    if args.mode == "dashboard":
        return args
    for kind in ("source", "mart"):
        if getattr(args, f"{kind}_jdbc"):
            lacking = [f"--{kind}-{what.replace('_', '-')}" for what in ("user", "password_file")
                       if not getattr(args, f"{kind}_{what}")]
            if lacking:
                parser.error(f"--{kind}-jdbc needs {' and '.join(lacking)}")
    if args.fact_table and not args.mart_jdbc:
        parser.error("--fact-table needs --mart-jdbc")
    if args.mode == "daily" and args.first and args.first > args.run_date:
        parser.error("--first is after --run-date")
    return args


def datasets(monthly: DataFrame, locality: DataFrame, year: int | None) -> dict[str, DataFrame]:
    """Everything the dashboard shows for a year."""
    year = dashboard.latest_year(monthly) if year is None else year
    return {
        "years": dashboard.years(monthly),
        "kpis": dashboard.kpis(monthly, year),
        "kpi_cards": dashboard.kpi_cards(monthly, year),
        "monthly": dashboard.monthly_charts(monthly, year),
        "state_top10": dashboard.state_top10(locality, year),
        "city_top20": dashboard.city_top20(locality, year),
        "locality": dashboard.locality_table(locality, year),
    }


def main(argv: Sequence[str] | None = None) -> None:
    args = _checked(_arguments(), argv)
    spark = cluster_session()
    warehouse = Warehouse(args.warehouse.rstrip("/"), args.lake)
    if args.mode == "dashboard":
        monthly = pipeline.stored_mart(spark, warehouse, MONTH_MART)
        locality = pipeline.stored_mart(spark, warehouse, LOCALITY_MART)
        for name, dataset in datasets(monthly, locality, args.year).items():
            print(name)
            dataset.show(truncate=False)
        return
    common = {
        "run_ts": datetime.now(),
        "calendar": Calendar(args.calendar_first, args.calendar_last),
        "mart_sink": _mart_sink(args),
        "fact_sink": _fact_sink(args),
    }
    src = _source(spark, args)
    try:
        with lease.held(spark, warehouse.root, args.lease_hours * 3600):
            if args.mode == "daily":
                report = pipeline.run_pipeline(
                    src, warehouse, args.run_date, first=args.first,
                    one_locality=args.one_locality, force_clear=args.force_clear, **common)
            else:
                report = pipeline.run_full_refresh(src, warehouse, args.years, **common)
    finally:
        staging.clear(spark)
    print("\n".join(report.lines()))


if __name__ == "__main__":
    main()
