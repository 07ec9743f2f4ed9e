"""Datasets behind the dashboard: KPI row, cards and six charts for one year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import labels
from salesmart.functions.numeric import attainment, or_zero, percent_of, total_money, total_quantity
from salesmart.operators.ranking import top_ranked
from salesmart.schemas import MONEY

# How many states and cities are charted, titles and texts of the cards.
TOP_STATES = 10
TOP_CITIES = 20
REVENUE, TARGET, QUANTITY, ATTAINMENT, BEST_MONTH = (
    "Receita Real", "Meta Esperada", "Qtde Vendida", "Atingimento", "Melhor Mês",
)
YEAR_TO_DATE = "acumulado anual"
AVERAGE_TICKET = "ticket médio "
ABOVE_TARGET, BELOW_TARGET = "acima da meta", "abaixo da meta"


def _of_year(mart: DataFrame, year: int) -> DataFrame:
    return mart.where(F.col("ano") == year)


def _deviation():
    return (F.col("valor_total_real") - F.col("valor_total_esperado")).cast(MONEY)


def years(monthly: DataFrame) -> DataFrame:
    """Years to choose from, latest first; the latest is the default."""
    latest = F.row_number().over(Window.orderBy(F.col("ano").desc())) == 1
    return (
        monthly.select("ano").distinct()
        .select("ano", latest.alias("padrao"))
        .orderBy(F.col("ano").desc())
    )


def latest_year(monthly: DataFrame) -> int:
    """The year shown when none is chosen."""
    return monthly.agg(F.max("ano")).first()[0]


def monthly_charts(mart: DataFrame, year: int) -> DataFrame:
    """Real against target, attainment, quantity and deviation per month."""
    pct, deviation = F.col("pct_ating"), F.col("desvio")
    return (
        _of_year(mart, year)
        .select(
            "id", "ano", "mes",
            labels.month_abbreviation(F.col("mes")).alias("nome_mes"),
            "qtde_vendida", "valor_total_real", "valor_total_esperado",
            _deviation().alias("desvio"),
            attainment(
                F.col("valor_total_real"), F.col("valor_total_esperado"), 1
            ).alias("pct_ating"),
        )
        .withColumn("faixa_ating", labels.attainment_band(pct))
        .withColumn("rotulo_ating", labels.percent(pct, 0))
        .withColumn("faixa_desvio", labels.sign_band(deviation))
        .withColumn("rotulo_desvio", labels.currency(deviation))
        .orderBy("ano", "mes")
    )


def locality_table(mart: DataFrame, year: int) -> DataFrame:
    return (
        _of_year(mart, year)
        .select(
            "ano", "sigla_estado", "estado", "cidade",
            "qtde_vendida", "valor_total_real", "valor_total_esperado", "pct_atingimento",
        )
        .orderBy("ano", "sigla_estado", "cidade")
    )


def kpis(monthly: DataFrame, year: int) -> DataFrame:
    """Totals, attainment, average ticket and best month of a year, one row.

    Of two best months the earlier wins.
    """
    best = F.max_by(
        F.struct("mes", "valor_total_real"),
        F.struct("valor_total_real", (-F.col("mes")).alias("earlier")),
    )
    real, target, quantity = F.col("receita_real"), F.col("receita_esperada"), F.col("qtde_vendida")
    return (
        _of_year(monthly, year)
        .agg(
            total_money("valor_total_real").alias("receita_real"),
            total_money("valor_total_esperado").alias("receita_esperada"),
            total_quantity("qtde_vendida").alias("qtde_vendida"),
            best.alias("best"),
        )
        .select(
            F.lit(year).alias("ano"), real, target, quantity,
            (real - target).cast(MONEY).alias("desvio"),
            or_zero(percent_of(real, target)).alias("pct_atingimento"),
            or_zero(
                F.try_divide(real.cast("double"), quantity.cast("double"))
            ).alias("ticket_medio"),
            labels.month_abbreviation(F.col("best.mes")).alias("melhor_mes"),
            F.col("best.valor_total_real").alias("melhor_valor"),
        )
    )


def kpi_cards(monthly: DataFrame, year: int) -> DataFrame:
    """The five cards as rows: title, value, detail and colours."""
    pct, deviation = F.col("pct_atingimento"), F.col("desvio")
    reached = pct >= labels.ON_TARGET_PCT
    band = F.when(reached, labels.GREEN).otherwise(labels.RED)
    muted, orange = F.lit(labels.MUTED), F.lit(labels.ORANGE)
    ticket = F.concat(F.lit(AVERAGE_TICKET), labels.currency(F.col("ticket_medio")))
    status = F.when(reached, ABOVE_TARGET).otherwise(BELOW_TARGET)
    cards = [
        (REVENUE, labels.currency(F.col("receita_real")),
         labels.versus_target(deviation), labels.sign_band(deviation), orange),
        (TARGET, labels.currency(F.col("receita_esperada")),
         F.lit(YEAR_TO_DATE), muted, orange),
        (QUANTITY, labels.thousands(F.col("qtde_vendida")), ticket, muted, orange),
        (ATTAINMENT, labels.percent(pct, 1), status, band, band),
        (BEST_MONTH, F.col("melhor_mes"),
         labels.currency(F.col("melhor_valor")), muted, orange),
    ]
    rows = [
        F.struct(
            F.lit(position).alias("ordem"),
            F.lit(title).alias("titulo"),
            value.alias("valor"),
            detail.alias("detalhe"),
            detail_colour.alias("cor_detalhe"),
            top_colour.alias("cor_topo"),
        )
        for position, (title, value, detail, detail_colour, top_colour) in enumerate(cards, 1)
    ]
    return kpis(monthly, year).select(F.inline(F.array(*rows)))


def state_top10(locality: DataFrame, year: int) -> DataFrame:
    """States with the largest real revenue, with a value and attainment label."""
    states = _real_and_target(_of_year(locality, year), "sigla_estado").withColumn(
        "pct", attainment(F.col("valor_total_real"), F.col("valor_total_esperado"), 1)
    )
    label = F.concat(
        labels.currency(F.col("valor_total_real")),
        F.lit("  ("), labels.percent(F.col("pct"), 0), F.lit(")"),
    )
    return top_ranked(
        states, TOP_STATES, "valor_total_real", "sigla_estado"
    ).withColumn("rotulo", label)


def city_top20(locality: DataFrame, year: int) -> DataFrame:
    """Cities by name only: cities of one name in two states are summed together."""
    cities = _real_and_target(_of_year(locality, year), "cidade")
    return top_ranked(cities, TOP_CITIES, "valor_total_real", "cidade")


def _real_and_target(locality: DataFrame, key: str) -> DataFrame:
    return locality.groupBy(key).agg(
        total_money("valor_total_real").alias("valor_total_real"),
        total_money("valor_total_esperado").alias("valor_total_esperado"),
    )
