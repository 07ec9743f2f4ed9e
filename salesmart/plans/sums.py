"""Sums beside the stored fact, so that the marts follow the loaded days only.

``somas_dia`` holds the fact summed per day and locality key, a folder per day;
``somas_ano`` and ``somas_mes`` sum these per year and locality key and per month, a folder
per year. A run replaces the days of its range, then the years that these touch. The marts
are built from the years' and months' sums: neither the fact nor other days are read again.
Sums are kept by key, not by place, so a reloaded dimension is always the current one.

The range is noted before the fact is loaded and the note removed once its sums are there.
A run that dies in between leaves the note, and the next run catches up.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.plans import marts
from salesmart.sinks import tables

DAY_SUMS, YEAR_SUMS, MONTH_SUMS = "somas_dia", "somas_ano", "somas_mes"
_PENDING = "_pendente"
_DAY = schemas.STORE_DAY.name
Range = tuple[date, date]


def note(spark: SparkSession, root: str, first: date, last: date) -> None:
    """Say that the facts of first..last are about to change."""
    tables.mark(spark, f"{root}/{_PENDING}/{first}_{last}")


def noted(spark: SparkSession, root: str) -> list[Range]:
    return [tuple(date.fromisoformat(day) for day in name.split("_"))
            for name in tables.names_in(spark, f"{root}/{_PENDING}") if "_" in name]


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in marts.MEASURES])


def day_sums(fact: DataFrame) -> DataFrame:
    """The fact per day and locality key, combined on the map side: a locality with a
    third of the day's sales is one row per task."""
    return _summed(fact, _DAY, "sk_tempo", "sk_localidade")


def _between(rows: DataFrame, first: date, last: date) -> DataFrame:
    return rows.where(F.col(_DAY).between(F.lit(first), F.lit(last)))


def refresh(spark: SparkSession, root: str, fact: DataFrame) -> set[int]:
    """Bring the sums of every noted range in line with the stored fact; returns the years.

    Of a fact that has no sums yet, all days are summed.
    """
    path = f"{root}/{DAY_SUMS}"
    ranges = noted(spark, root)
    years: set[int] = set()
    if not tables.exists(spark, path):
        changed = {(): fact}
    else:
        changed = {(first, last): _between(fact, first, last) for first, last in ranges}
    for bounds, rows in changed.items():
        first, last = map(str, bounds or ("", "~"))
        before = {day for day in tables.partition_values(spark, path, _DAY) if first <= day <= last}
        written = tables.replace_partitions(day_sums(rows), path, schemas.DAY_SUMS, _DAY)
        tables.drop_partitions(spark, path, _DAY, before - written)
        years |= {int(day[:4]) for day in before | written}
    _refresh_years(spark, root, years)
    for first, last in ranges:
        tables.remove(spark, f"{root}/{_PENDING}/{first}_{last}")
    return years


def _refresh_years(spark: SparkSession, root: str, years: set[int]) -> None:
    """Sum the days of some years again; sales without a day key are in no mart."""
    of_years = [F.col(_DAY).between(F.lit(date(y, 1, 1)), F.lit(date(y, 12, 31))) for y in sorted(years)]
    if not of_years:
        return
    wanted = of_years[0]
    for more in of_years[1:]:
        wanted = wanted | more
    dated = tables.read_table(spark, f"{root}/{DAY_SUMS}", schemas.DAY_SUMS) \
        .where(wanted & F.col("sk_tempo").isNotNull()) \
        .withColumn("ano", F.year(_DAY)).withColumn("mes", F.month(_DAY))
    for name, rows, schema in (
        (YEAR_SUMS, _summed(dated.where("sk_localidade is not null"), "ano", "sk_localidade"),
         schemas.YEAR_SUMS),
        (MONTH_SUMS, _summed(dated, "ano", "mes"), schemas.MONTH_SUMS),
    ):
        written = tables.replace_partitions(rows, f"{root}/{name}", schema, "ano")
        tables.drop_partitions(
            spark, f"{root}/{name}", "ano", {str(y) for y in years} - written)


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """Sums that are there; before the first sale there are none."""
    found = tables.read_if_present(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def stored_days(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, f"{root}/{DAY_SUMS}", schemas.DAY_SUMS)


def monthly_sales(spark: SparkSession, root: str) -> DataFrame:
    """Monthly mart rows."""
    return marts.month_totals(
        _stored(spark, f"{root}/{MONTH_SUMS}", schemas.MONTH_SUMS))


def locality_sales(spark: SparkSession, root: str, localidade: DataFrame) -> DataFrame:
    """Locality mart rows under the current dimension."""
    return marts.locality_of_sums(
        _stored(spark, f"{root}/{YEAR_SUMS}", schemas.YEAR_SUMS), localidade)
