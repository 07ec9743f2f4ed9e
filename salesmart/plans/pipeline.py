"""The daily run and the full refresh, stage by stage."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart import schemas
from salesmart.operators.keys import attach_keys, new_keys
from salesmart.operators.staging import stage
from salesmart.plans import dims, lake, late, marts, quality, sums
from salesmart.plans.fact import sales_fact
from salesmart.sinks import tables
from salesmart.sources.calendar import Calendar, dim_tempo
from salesmart.sources.lake import read_lake
from salesmart.sources.tables import SalesSource

FACT = "fato_venda"
DIGESTS = "digests_dia"
QUALITY = "qualidade"
MONTH_MART = "vendas_ano_mes"
LOCALITY_MART = "vendas_localidade"

MART_SCHEMAS = {
    MONTH_MART: schemas.MART_ANO_MES,
    LOCALITY_MART: schemas.MART_LOCALIDADE,
}

MartSink = Callable[[DataFrame, str], None]
#: Gets the loaded facts, and the range of day keys to empty even where nothing was loaded.
FactSink = Callable[[DataFrame, tuple[int, int] | None], None]


@dataclass(frozen=True)
class Warehouse:
    """Folder of the stored tables, and optionally another place for the lake."""

    root: str
    lake_root: str | None = None

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def key_map(self, name: str) -> str:
        return f"{self.root}/keys/{name}"

    @property
    def lake(self) -> str:
        return self.lake_root or f"{self.root}/lake/{FACT}"

    @property
    def base(self) -> Warehouse:
        """The base mode's tables, which have other columns than the main mode's."""
        return Warehouse(f"{self.root}/base", self.lake_root and f"{self.lake_root}/base")


@dataclass
class RunReport:
    """Rows written per table, and loaded facts without a key, per key."""

    counts: dict[str, int] = field(default_factory=dict)
    missing: dict[str, int] = field(default_factory=dict)

    def lines(self) -> list[str]:
        written = [f"{name}: {count} rows" for name, count in self.counts.items()]
        return written + [f"{FACT}: {n} rows without {key}" for key, n in self.missing.items()]


@dataclass(frozen=True)
class _Dimension:
    rows: Callable[[SalesSource], DataFrame]
    sk: str
    natural_key: list[str]
    schema: T.StructType


_PRODUTO = _Dimension(
    dims.produto_rows, "sk_produto", dims.PRODUTO_KEY, schemas.DIM_PRODUTO)
_CLIENTE = _Dimension(
    dims.cliente_rows, "sk_cliente", dims.PESSOA_KEY, schemas.DIM_CLIENTE)
_CLIENTE_PF = _Dimension(
    dims.cliente_pf_rows, "sk_cliente", dims.PESSOA_KEY, schemas.DIM_CLIENTE_PF)
_VENDEDOR = _Dimension(
    dims.vendedor_rows, "sk_vendedor", dims.PESSOA_KEY, schemas.DIM_VENDEDOR)
_LOCALIDADE = _Dimension(
    dims.localidade_rows, "sk_localidade", dims.LOCALIDADE_KEY, schemas.DIM_LOCALIDADE)

MAIN_DIMENSIONS = {
    "produto": _PRODUTO, "cliente": _CLIENTE,
    "vendedor": _VENDEDOR, "localidade": _LOCALIDADE,
}
BASE_DIMENSIONS = {"produto": _PRODUTO, "cliente": _CLIENTE_PF, "vendedor": _VENDEDOR}


def load_dimension(
    src: SalesSource, warehouse: Warehouse, name: str, dimension: _Dimension
) -> int:
    """Full reload of a dimension under keys that never change.

    Keys live in a map that is only ever appended to: a key seen before keeps its
    number, and the number of a vanished one is not given out again, so the stored
    fact always points at the same thing. The dimension itself can be rewritten or
    lost at any time and rebuilt from the map.
    """
    spark, sk, natural_key = src.spark, dimension.sk, dimension.natural_key
    map_schema = T.StructType(
        [f for f in dimension.schema if f.name == sk or f.name in natural_key]
    )
    map_path = warehouse.key_map(name)
    rows = stage(dimension.rows(src), name)
    known = tables.read_if_present(spark, map_path, map_schema)
    if known is None:
        known = spark.createDataFrame([], map_schema)
    added = new_keys(rows, sk, natural_key, known)
    # A run without new keys adds no files to the map.
    if not tables.exists(spark, map_path) or not added.isEmpty():
        tables.append(added, map_path, map_schema)
    complete = tables.read_table(spark, map_path, map_schema)
    keyed = attach_keys(rows, sk, natural_key, complete)
    return tables.write_full(keyed, warehouse.table(name), dimension.schema)


def load_dimensions(
    src: SalesSource,
    warehouse: Warehouse,
    calendar: Calendar,
    dimensions: dict[str, _Dimension],
) -> dict[str, int]:
    """Calendar and the given dimensions, loaded side by side; returns row counts."""
    tempo = dim_tempo(src.spark, calendar)
    counts = {
        "dim_tempo": tables.write_full(tempo, warehouse.table("dim_tempo"), schemas.DIM_TEMPO)
    }
    with ThreadPoolExecutor(len(dimensions)) as pool:
        jobs = {
            f"dim_{short}": pool.submit(
                load_dimension, src, warehouse, f"dim_{short}", dimension)
            for short, dimension in dimensions.items()
        }
        counts.update((name, job.result()) for name, job in jobs.items())
    return counts


def stored_star(
    spark: SparkSession, warehouse: Warehouse, dimensions: dict[str, _Dimension]
) -> dims.Star:
    stored = {
        short: tables.read_table(spark, warehouse.table(f"dim_{short}"), dimension.schema)
        for short, dimension in dimensions.items()
    }
    tempo = tables.read_table(spark, warehouse.table("dim_tempo"), schemas.DIM_TEMPO)
    return dims.Star(tempo=tempo, **stored)


def stored_fact(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return tables.read_table(spark, warehouse.table(FACT), schemas.FATO_VENDA_STORE)


def load_fact(
    src: SalesSource,
    warehouse: Warehouse,
    first: date,
    last: date,
    one_locality: bool = False,
) -> tuple[int, set[date]]:
    """Replace the sales of the days first..last; returns the rows and days written."""
    star = stored_star(src.spark, warehouse, MAIN_DIMENSIONS)
    if one_locality:
        star = dims.with_one_locality(star)
    fact = sales_fact(src, star, first, last)
    return tables.replace_fact_days(
        fact, warehouse.table(FACT), schemas.FATO_VENDA_STORE, gather=first != last
    )


def clear_days_without_sales(
    spark: SparkSession, warehouse: Warehouse, first: date, last: date, loaded: set[date]
) -> None:
    """Empty the stored days of first..last that the load just made did not write."""
    day = schemas.STORE_DAY.name
    in_range = F.col(day).between(F.lit(first), F.lit(last))
    # At most one row per day of the range.
    stored = stored_fact(spark, warehouse).where(in_range).select(day).distinct().collect()
    tables.drop_fact_days(spark, warehouse.table(FACT), {row[day] for row in stored} - loaded)


def load_digests(
    src: SalesSource, warehouse: Warehouse, first: date, last: date, force_clear: bool
) -> None:
    """Digests of the loaded days as the source has them now. A day without sales whose
    stored rows were left alone keeps its digest, so that it still shows as changed."""
    path, day = warehouse.table(DIGESTS), schemas.STORE_DAY.name
    written = tables.replace_partitions(
        late.day_digests(src, first, last), path, schemas.DAY_DIGESTS, day)
    if force_clear:
        stored = tables.partition_values(src.spark, path, day)
        tables.drop_partitions(src.spark, path, day, {
            value for value in stored if str(first) <= value <= str(last)} - written)


def late_days(
    src: SalesSource, warehouse: Warehouse, first: date | None, last: date
) -> DataFrame:
    """Days of first..last whose source rows are not those that were loaded."""
    day = F.col(schemas.STORE_DAY.name)
    stored = tables.read_if_present(src.spark, warehouse.table(DIGESTS), schemas.DAY_DIGESTS)
    if stored is None:
        stored = src.spark.createDataFrame([], schemas.DAY_DIGESTS)
    stored = stored.where(day <= F.lit(last))
    if first is not None:
        stored = stored.where(day >= F.lit(first))
    return late.changed_days(late.day_digests(src, first, last), stored)


def run_late_days(
    src: SalesSource, warehouse: Warehouse, run_date: date, run_ts: datetime,
    since: date | None = None, **options,
) -> list[RunReport]:
    """Load again the days up to the run date that changed in the source, a run for each
    range of consecutive days. ``since`` bounds how far back the source is read."""
    # At most one row per day.
    changed = [row[0] for row in late_days(src, warehouse, since, run_date).collect()]
    return [
        run_pipeline(src, warehouse, last, run_ts, first=first, force_clear=True, **options)
        for first, last in late.in_ranges(changed)
    ]


def check_run(
    spark: SparkSession, warehouse: Warehouse, first: date, last: date, run_ts: datetime
) -> None:
    """Facts of first..last without a dimension row, and totals of sums against marts.

    The findings are appended to the quality table before a wrong one fails the run. Totals
    are taken from the days' sums, so the fact is not read again.
    """
    star = stored_star(spark, warehouse, MAIN_DIMENSIONS)
    day = F.col(schemas.STORE_DAY.name)
    loaded = stored_fact(spark, warehouse).where(day.between(F.lit(first), F.lit(last)))
    report = stage(quality.run_report(
        quality.referential_integrity(loaded, star),
        quality.reconciliation(
            sums.stored_days(spark, warehouse.root), star,
            stored_mart(spark, warehouse, MONTH_MART), stored_mart(spark, warehouse, LOCALITY_MART)),
    ), QUALITY)
    tables.append(marts.stamped(report, run_ts), warehouse.table(QUALITY), schemas.QUALITY)
    wrong = quality.failures(report.collect())
    if wrong:
        raise quality.ValidationError("; ".join(wrong))


def load_lake_months(
    spark: SparkSession, warehouse: Warehouse, first: date, last: date
) -> int:
    """Replace the lake snapshot of every month that first..last touches."""
    star = stored_star(spark, warehouse, MAIN_DIMENSIONS)
    fact = tables.read_fact_months(
        spark, warehouse.table(FACT), schemas.FATO_VENDA_STORE, first, last
    )
    rows = lake.lake_months_rows(fact, star.tempo, star.localidade, first, last)
    several = (first.year, first.month) != (last.year, last.month)
    return tables.write_lake_months(rows, warehouse.lake, schemas.LAKE, gather=several)


def settled_calendar(
    spark: SparkSession, warehouse: Warehouse, calendar: Calendar, run_date: date | None = None
) -> Calendar:
    """The calendar that a run stores: it reaches the run date's year and never shrinks.

    A day's key is its position, so the first day of a warehouse is fixed by its first
    run. Another one would move every stored sale to another date and is refused.
    """
    if run_date is not None:
        calendar = calendar.reaching(run_date)
    stored = tables.read_if_present(spark, warehouse.table("dim_tempo"), schemas.DIM_TEMPO)
    if stored is None:
        return calendar
    first, last = stored.agg(F.min("data"), F.max("data")).first()
    if first is not None and first != calendar.first:
        raise ValueError(f"the calendar of this warehouse begins on {first}, not {calendar.first}")
    return calendar if last is None else replace(calendar, last=max(last, calendar.last))


def _report_keys(spark: SparkSession, warehouse: Warehouse, first: date, last: date,
                 calendar: Calendar) -> dict[str, int]:
    """Rows of the loaded days without a key, per key. A day from the calendar's start on
    must have its key."""
    day = F.col(schemas.STORE_DAY.name)
    loaded = stored_fact(spark, warehouse).where(day.between(F.lit(first), F.lit(last)))
    missing = quality.null_keys(loaded).first().asDict()
    if missing["sk_tempo"] and quality.undated(loaded, calendar.first):
        raise quality.ValidationError("loaded days are not in the calendar")
    return {key: n for key, n in missing.items() if n}


def load_marts(
    spark: SparkSession, warehouse: Warehouse, run_ts: datetime, sink: MartSink | None = None
) -> dict[str, int]:
    """Both marts from the stored sums, under one audit timestamp."""
    star = stored_star(spark, warehouse, MAIN_DIMENSIONS)
    monthly = marts.mart_ano_mes(sums.monthly_sales(spark, warehouse.root))
    locality = marts.mart_localidade(
        sums.locality_sales(spark, warehouse.root, star.localidade)
    )
    return {
        name: _write_mart(mart, warehouse, name, run_ts, sink)
        for name, mart in ((MONTH_MART, monthly), (LOCALITY_MART, locality))
    }


def stored_mart(spark: SparkSession, warehouse: Warehouse, name: str) -> DataFrame:
    """A mart as the dashboard reads it."""
    return tables.read_table(spark, warehouse.table(name), MART_SCHEMAS[name])


def _write_mart(
    mart: DataFrame,
    warehouse: Warehouse,
    name: str,
    run_ts: datetime,
    sink: MartSink | None,
) -> int:
    count = tables.write_full(
        marts.stamped(mart, run_ts), warehouse.table(name), MART_SCHEMAS[name]
    )
    if sink is not None:
        sink(stored_mart(mart.sparkSession, warehouse, name), name)
    return count


def run_pipeline(
    src: SalesSource,
    warehouse: Warehouse,
    run_date: date,
    run_ts: datetime,
    calendar: Calendar = Calendar(),
    first: date | None = None,
    one_locality: bool = False,
    force_clear: bool = False,
    mart_sink: MartSink | None = None,
    fact_sink: FactSink | None = None,
) -> RunReport:
    """Dimensions, fact day, sums, lake month, marts, validation, checks.

    ``fact_sink`` gets the facts stored for the loaded days once the run is validated.
    ``first`` loads the days first..run_date instead of one. The rows stored for a
    day that now has no sales are left alone unless ``force_clear`` is set. One run at a
    time: two could give out the same key, so callers hold the warehouse's lease.
    """
    spark = src.spark
    first = first or run_date
    calendar = settled_calendar(spark, warehouse, calendar, run_date)
    report = RunReport()
    report.counts.update(load_dimensions(src, warehouse, calendar, MAIN_DIMENSIONS))
    sums.note(spark, warehouse.root, first, run_date)
    report.counts[FACT], loaded = load_fact(src, warehouse, first, run_date, one_locality)
    if force_clear:
        clear_days_without_sales(spark, warehouse, first, run_date, loaded)
    load_digests(src, warehouse, first, run_date, force_clear)
    sums.refresh(spark, warehouse.root, stored_fact(spark, warehouse))
    report.missing = _report_keys(spark, warehouse, first, run_date, calendar)
    report.counts["lake"] = load_lake_months(spark, warehouse, first, run_date)
    report.counts.update(load_marts(spark, warehouse, run_ts, mart_sink))
    quality.validate(report.counts)
    check_run(spark, warehouse, first, run_date, run_ts)
    if fact_sink is not None and (loaded or force_clear):
        day = F.col(schemas.STORE_DAY.name)
        fact_sink(stored_fact(spark, warehouse).where(day.between(F.lit(first), F.lit(run_date))),
                  _day_keys(calendar, first, run_date) if force_clear else None)
    return report


def _day_keys(calendar: Calendar, first: date, last: date) -> tuple[int, int] | None:
    """Smallest and largest day key of first..last; a day's key is its position."""
    low, high = max(first, calendar.first), min(last, calendar.last)
    if low > high:
        return None
    return (low - calendar.first).days + 1, (high - calendar.first).days + 1


def run_full_refresh(
    src: SalesSource,
    warehouse: Warehouse,
    years: Sequence[int],
    run_ts: datetime,
    calendar: Calendar = Calendar(),
    mart_sink: MartSink | None = None,
    fact_sink: FactSink | None = None,
) -> RunReport:
    """Base mode: natural-person buyers, whole fact, whole lake, monthly mart.

    The mart is computed from the lake and covers the given years only. The tables are in
    the warehouse's ``base`` folder, apart from those of the daily runs.
    """
    spark = src.spark
    warehouse = warehouse.base
    calendar = settled_calendar(spark, warehouse, calendar)
    report = RunReport()
    report.counts.update(load_dimensions(src, warehouse, calendar, BASE_DIMENSIONS))
    star = stored_star(spark, warehouse, BASE_DIMENSIONS)
    schema = schemas.FATO_VENDA_BASE_STORE
    path = warehouse.table(FACT)
    report.counts[FACT] = tables.write_fact_full(sales_fact(src, star), path, schema)
    fact = tables.read_table(spark, path, schema)
    report.counts["lake"] = tables.write_lake_full(
        lake.lake_base_rows(fact, star.tempo), warehouse.lake, schemas.LAKE_BASE
    )
    rows = read_lake(spark, warehouse.lake, schemas.LAKE_BASE, years)
    monthly = marts.mart_ano_mes(marts.month_totals(rows))
    report.counts[MONTH_MART] = _write_mart(
        monthly, warehouse, MONTH_MART, run_ts, mart_sink
    )
    if fact_sink is not None:
        fact_sink(fact, None)
    return report


def warehouse_counts(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Row counts of the stored tables of the main mode."""
    star = stored_star(spark, warehouse, MAIN_DIMENSIONS)
    stored = {
        **star.tables(),
        FACT: stored_fact(spark, warehouse),
        "lake": tables.read_table(spark, warehouse.lake, schemas.LAKE),
        **{name: stored_mart(spark, warehouse, name) for name in MART_SCHEMAS},
    }
    return quality.row_counts(stored)
