"""Calendar dimension generated from its bounds."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.schemas import DIM_TEMPO


@dataclass(frozen=True)
class Calendar:
    """First and last day, both included. The defaults are fixed values."""

    first: date = date(2015, 1, 1)
    last: date = date(2026, 12, 31)

    def reaching(self, day: date) -> Calendar:
        """This calendar, longer if needed so that the year of ``day`` is in it."""
        return replace(self, last=max(self.last, date(day.year, 12, 31)))

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1


def calendar_covering(invoices: DataFrame) -> Calendar:
    """The whole years that hold every invoice, for use where no bounds are given."""
    span = invoices.agg(
        F.year(F.min("data_venda")).alias("first"), F.year(F.max("data_venda")).alias("last")
    ).first()
    return Calendar(date(span["first"], 1, 1), date(span["last"], 12, 31))


def dim_tempo(spark: SparkSession, calendar: Calendar) -> DataFrame:
    """One row per day; the key is the day's position in the calendar."""
    day = F.date_add(F.lit(calendar.first), (F.col("sk_tempo") - 1).cast("int"))
    days = spark.range(1, calendar.days + 1, numPartitions=1).toDF("sk_tempo")
    data = F.col("data")
    return days.withColumn("data", day).select(
        "sk_tempo",
        "data",
        F.year(data).alias("ano"),
        F.month(data).alias("mes"),
        F.quarter(data).alias("trimestre"),
        F.date_format(data, "MMMM").alias("nome_mes"),
        F.date_format(data, "EEEE").alias("dia_semana"),
        (F.weekday(data) >= 5).alias("is_fim_semana"),
    ).select(*DIM_TEMPO.names)


def days(tempo: DataFrame, *columns: str) -> DataFrame:
    """Columns of the calendar, to be sent to every task.

    A calendar has one row per day and so never grows with the sales; a join that
    shuffled the fact by day would put a busy day into one task.
    """
    return F.broadcast(tempo.select(*columns))
