"""Rows of the data lake."""

from __future__ import annotations

import calendar as _calendar
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.sources.calendar import days

STORE_DAY = schemas.STORE_DAY.name


def month_of(run_date: date) -> tuple[date, date]:
    """First and last day of a run date's month."""
    last = _calendar.monthrange(run_date.year, run_date.month)[1]
    return run_date.replace(day=1), run_date.replace(day=last)


def lake_base_rows(fact: DataFrame, tempo: DataFrame) -> DataFrame:
    """Whole fact with its year and month, three data columns."""
    return fact.join(days(tempo, "sk_tempo", "ano", "mes"), "sk_tempo").select(
        *schemas.LAKE_BASE.names
    )


def lake_month_rows(
    fact: DataFrame, tempo: DataFrame, localidade: DataFrame, run_date: date
) -> DataFrame:
    """All sales of the run date's month with city and state."""
    return lake_months_rows(fact, tempo, localidade, run_date, run_date)


def lake_months_rows(
    fact: DataFrame, tempo: DataFrame, localidade: DataFrame, first: date, last: date
) -> DataFrame:
    """All sales of the months that first..last touch, with city and state.

    On a fact that carries its storage date, the months are also a range of that
    partition column, so the other days are never read.
    """
    first, last = month_of(first)[0], month_of(last)[1]
    if STORE_DAY in fact.columns:
        fact = fact.where(F.col(STORE_DAY).between(F.lit(first), F.lit(last)))
    month = tempo.where(F.col("data").between(F.lit(first), F.lit(last)))
    places = localidade.select("sk_localidade", "sigla_estado", "cidade")
    return (
        fact.join(days(month, "sk_tempo", "data", "ano", "mes"), "sk_tempo")
        .join(places, "sk_localidade", "left")
        .select(*schemas.LAKE.names)
    )
