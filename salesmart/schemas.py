"""Declared schema of every table the engine stores.

Column names and order, VARCHAR lengths and NUMERIC precisions are fixed values:
they are the contract of the warehouse, the lake and the marts. Keys and
quantities are 64-bit because a monthly quantity over billions of invoice lines
does not fit the 32 bits of an SQL INTEGER.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
DISCOUNT_PCT = T.DecimalType(5, 2)
ATTAINMENT_PCT = T.DecimalType(8, 2)

_MAX_LENGTH = "max_length"


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


def _key(name: str) -> T.StructField:
    return _field(name, T.LongType())


def _int(name: str) -> T.StructField:
    return _field(name, T.IntegerType())


def _text(name: str, max_length: int) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {_MAX_LENGTH: max_length})


def _money(name: str) -> T.StructField:
    return _field(name, MONEY)


# --- star schema ------------------------------------------------------------

DIM_TEMPO = T.StructType([
    _key("sk_tempo"), _field("data", T.DateType()),
    _int("ano"), _int("mes"), _int("trimestre"),
    _text("nome_mes", 20), _text("dia_semana", 20),
    _field("is_fim_semana", T.BooleanType()),
])

DIM_PRODUTO = T.StructType([
    _key("sk_produto"), _key("id_produto"),
    _text("nome", 200), _text("categoria", 100), _money("preco_tabela"),
])

DIM_CLIENTE = T.StructType([
    _key("sk_cliente"), _key("id_pessoa"),
    _text("nome", 200), _text("documento", 20), _text("tipo_pessoa", 2),
])

DIM_CLIENTE_PF = T.StructType([
    _key("sk_cliente"), _key("id_pessoa"), _text("nome", 200), _text("cpf", 20),
])

DIM_VENDEDOR = T.StructType([
    _key("sk_vendedor"), _key("id_pessoa"), _text("nome", 200),
])

DIM_LOCALIDADE = T.StructType([
    _key("sk_localidade"), _key("id_pessoa"),
    _text("bairro", 200), _text("cidade", 200),
    _text("sigla_estado", 2), _text("estado", 100), _text("cep", 10),
])

_FACT_MEASURES = [
    _key("id_nota"), _key("quantidade"),
    _money("valor_unitario"), _money("valor_venda_real"),
    _money("desconto"), _field("pct_desconto", DISCOUNT_PCT),
]

FATO_VENDA_BASE = T.StructType([
    _key("sk_tempo"), _key("sk_produto"), _key("sk_cliente"), _key("sk_vendedor"),
    *_FACT_MEASURES,
])

FATO_VENDA = T.StructType([
    _key("sk_tempo"), _key("sk_produto"), _key("sk_cliente"), _key("sk_vendedor"),
    _key("sk_localidade"),
    *_FACT_MEASURES,
])

# The stored fact carries the sale date as its partition column: days are replaced
# by date, which also works for sales that have no calendar key.
STORE_DAY = _field("data_venda", T.DateType())
FATO_VENDA_STORE = T.StructType([*FATO_VENDA.fields, STORE_DAY])
FATO_VENDA_BASE_STORE = T.StructType([*FATO_VENDA_BASE.fields, STORE_DAY])

# --- sums beside the fact ---------------------------------------------------

_SUM = T.DecimalType(28, 2)
_SUMS = [_key("quantidade"), _field("valor_unitario", _SUM), _field("valor_venda_real", _SUM)]
DAY_SUMS = T.StructType([_key("sk_tempo"), _key("sk_localidade"), *_SUMS, STORE_DAY])
YEAR_SUMS = T.StructType([_key("sk_localidade"), *_SUMS, _int("ano")])
MONTH_SUMS = T.StructType([_int("mes"), *_SUMS, _int("ano")])

# Rows of a day in the source when it was loaded: how many, and a digest of them.
DAY_DIGESTS = T.StructType([
    _key("linhas"), _field("digest", T.DecimalType(38, 0)), STORE_DAY,
])

# What a run found: one row per check and item.
QUALITY = T.StructType([
    _field("data_atualizacao", T.TimestampType()), _text("verificacao", 40), _text("item", 40),
    _key("chaves"), _key("linhas"), _field("valor_real", _SUM), _field("valor_esperado", _SUM),
])

# --- lake -------------------------------------------------------------------

_LAKE_PARTITIONS = [_int("ano"), _int("mes")]

LAKE_BASE = T.StructType([
    _key("quantidade"), _money("valor_unitario"), _money("valor_venda_real"),
    *_LAKE_PARTITIONS,
])

LAKE = T.StructType([
    _field("data", T.DateType()),
    _key("quantidade"), _money("valor_unitario"), _money("valor_venda_real"),
    _text("sigla_estado", 2), _text("cidade", 200),
    *_LAKE_PARTITIONS,
])

# --- marts ------------------------------------------------------------------

_MART_TOTALS = [
    _key("qtde_vendida"), _money("valor_total_real"), _money("valor_total_esperado"),
]
_AUDIT = _field("data_atualizacao", T.TimestampType())

MART_ANO_MES = T.StructType([_key("id"), _int("ano"), _int("mes"), *_MART_TOTALS, _AUDIT])

MART_LOCALIDADE = T.StructType([
    _key("id"), _int("ano"),
    _text("sigla_estado", 2), _text("estado", 100), _text("cidade", 200),
    *_MART_TOTALS, _field("pct_atingimento", ATTAINMENT_PCT), _AUDIT,
])


def without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])


def _stored(df: DataFrame, field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(df.schema[field.name].dataType, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    value = value.cast(field.dataType)
    limit = (field.metadata or {}).get(_MAX_LENGTH)
    if limit is not None:
        too_long = F.raise_error(
            F.concat(F.lit(f"{field.name} is longer than {limit}: "), value)
        )
        value = F.when(F.length(value) > limit, too_long).otherwise(value)
    return value.alias(field.name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema, as every writer does.

    NaN becomes NULL; a number outside its precision or a text over its length
    fails the job.
    """
    return df.select(*[_stored(df, field) for field in schema.fields])
