"""The five dimensions of the star schema."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.keys import stable_keys
from salesmart.sources.calendar import Calendar, dim_tempo
from salesmart.sources.tables import SalesSource

# Natural keys, which also give the order of the surrogate keys. A person may have
# many addresses, so the whole row is the natural key of a locality.
PRODUTO_KEY = ["id_produto"]
PESSOA_KEY = ["id_pessoa"]
LOCALIDADE_KEY = ["id_pessoa", "cep", "bairro", "cidade", "sigla_estado", "estado"]


@dataclass(frozen=True)
class Star:
    """Dimensions to look keys up in; a plan joins only those it is given."""

    tempo: DataFrame | None = None
    produto: DataFrame | None = None
    cliente: DataFrame | None = None
    vendedor: DataFrame | None = None
    localidade: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {
            f"dim_{name}": getattr(self, name)
            for name in ("tempo", "produto", "cliente", "vendedor", "localidade")
            if getattr(self, name) is not None
        }


def _invoiced(src: SalesSource, column: str) -> DataFrame:
    """Distinct persons on invoices.

    The distinct combines on the map side, so a person with a third of all
    invoices sends one row per task, not all of them, into the semi join.
    """
    return (
        src.nota_fiscal.select(F.col(column).alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
    )


def produto_rows(src: SalesSource) -> DataFrame:
    category = src.categoria.select(
        F.col("id").alias("id_categoria"), F.col("descricao").alias("categoria")
    )
    return src.produto.join(category, "id_categoria").select(
        F.col("id").cast("long").alias("id_produto"),
        "nome",
        "categoria",
        F.col("valor_venda").alias("preco_tabela"),
    )


def cliente_rows(src: SalesSource) -> DataFrame:
    """Buyers that are natural or legal persons; natural wins column by column."""
    natural = src.pessoa_fisica.select("id", "nome", "cpf", F.lit(True).alias("is_pf"))
    legal = src.pessoa_juridica.select(
        "id", "razao_social", "cnpj", F.lit(True).alias("is_pj")
    )
    return (
        src.pessoa.join(_invoiced(src, "id_cliente"), "id", "left_semi")
        .join(natural, "id", "left")
        .join(legal, "id", "left")
        .where(F.col("is_pf").isNotNull() | F.col("is_pj").isNotNull())
        .select(
            F.col("id").cast("long").alias("id_pessoa"),
            F.coalesce("nome", "razao_social").alias("nome"),
            F.coalesce("cpf", "cnpj").alias("documento"),
            F.when(F.col("is_pf").isNotNull(), "PF").otherwise("PJ").alias("tipo_pessoa"),
        )
        .distinct()
    )


def cliente_pf_rows(src: SalesSource) -> DataFrame:
    """Buyers that are natural persons (base mode)."""
    return (
        src.pessoa_fisica.join(_invoiced(src, "id_cliente"), "id", "left_semi")
        .select(F.col("id").cast("long").alias("id_pessoa"), "nome", "cpf")
        .distinct()
    )


def vendedor_rows(src: SalesSource) -> DataFrame:
    """Natural persons that sold at least once."""
    return (
        src.sellers.join(_invoiced(src, "id_vendedor"), "id", "left_semi")
        .select(F.col("id").cast("long").alias("id_pessoa"), "nome")
        .distinct()
    )


def localidade_rows(src: SalesSource) -> DataFrame:
    """One row per address; its district, city and state may be unknown."""
    state = src.estado.select(
        F.col("id").alias("id_estado"),
        F.col("sigla").alias("sigla_estado"),
        F.col("descricao").alias("estado"),
    )
    city = src.cidade.select(
        F.col("id").alias("id_cidade"), F.col("descricao").alias("cidade"), "id_estado"
    )
    district = src.bairro.select(
        F.col("id").alias("id_bairro"), F.col("descricao").alias("bairro"), "id_cidade"
    )
    place = district.join(city, "id_cidade", "left").join(state, "id_estado", "left")
    person = src.pessoa.select(F.col("id").alias("id_pessoa"))
    # Copies of an address are merged on the map side before any join.
    addresses = (
        src.endereco.where(F.col("id").isNotNull())
        .select("id_pessoa", "id_bairro", "cep")
        .distinct()
    )
    rows = (
        addresses.join(person, "id_pessoa", "left_semi")
        .join(place, "id_bairro", "left")
        .select(
            F.col("id_pessoa").cast("long").alias("id_pessoa"),
            "bairro", "cidade", "sigla_estado", "estado", "cep",
        )
    )
    # Districts may share a name, so rows can still be equal. Partitioned by the whole
    # row: the distinct would otherwise settle for the person, keep all addresses of
    # one person in a single task, and bar adaptive execution from splitting them.
    return rows.repartition(*rows.columns).distinct()


def dim_produto(src: SalesSource, existing: DataFrame | None = None) -> DataFrame:
    return stable_keys(produto_rows(src), "sk_produto", PRODUTO_KEY, existing)


def dim_cliente(src: SalesSource, existing: DataFrame | None = None) -> DataFrame:
    return stable_keys(cliente_rows(src), "sk_cliente", PESSOA_KEY, existing)


def dim_cliente_pf(src: SalesSource, existing: DataFrame | None = None) -> DataFrame:
    return stable_keys(cliente_pf_rows(src), "sk_cliente", PESSOA_KEY, existing)


def dim_vendedor(src: SalesSource, existing: DataFrame | None = None) -> DataFrame:
    return stable_keys(vendedor_rows(src), "sk_vendedor", PESSOA_KEY, existing)


def dim_localidade(src: SalesSource, existing: DataFrame | None = None) -> DataFrame:
    return stable_keys(localidade_rows(src), "sk_localidade", LOCALIDADE_KEY, existing)


def one_locality_per_person(localidade: DataFrame) -> DataFrame:
    """The first address of each person, by key: no fan-out in the fact."""
    first = localidade.groupBy("id_pessoa").agg(F.min("sk_localidade").alias("sk_localidade"))
    return localidade.join(first.select("sk_localidade"), "sk_localidade", "left_semi")


def with_one_locality(star: Star) -> Star:
    return replace(star, localidade=one_locality_per_person(star.localidade))


def star(src: SalesSource, calendar: Calendar) -> Star:
    """All five dimensions, keyed from 1."""
    return _built(src, calendar, {
        "produto": dim_produto,
        "cliente": dim_cliente,
        "vendedor": dim_vendedor,
        "localidade": dim_localidade,
    })


def base_star(src: SalesSource, calendar: Calendar) -> Star:
    """Base mode: natural persons only and no locality."""
    return _built(src, calendar, {
        "produto": dim_produto, "cliente": dim_cliente_pf, "vendedor": dim_vendedor,
    })


def _built(src: SalesSource, calendar: Calendar, builders: dict) -> Star:
    """The dimensions do not depend on each other, so their jobs share the cluster."""
    with ThreadPoolExecutor(len(builders)) as pool:
        jobs = {name: pool.submit(build, src) for name, build in builders.items()}
        tables = {name: job.result() for name, job in jobs.items()}
    return Star(tempo=dim_tempo(src.spark, calendar), **tables)
