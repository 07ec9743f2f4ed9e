"""The transactional tables that the warehouse is built from."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Schema-qualified names and the columns used of each source table.
SOURCE_SCHEMAS = {
    "geral.pessoa": "id long",
    "geral.pessoa_fisica": "id long, nome string, cpf string",
    "geral.pessoa_juridica": "id long, razao_social string, cnpj string",
    "geral.endereco": "id long, id_pessoa long, id_bairro long, cep string",
    "geral.bairro": "id long, descricao string, id_cidade long",
    "geral.cidade": "id long, descricao string, id_estado long",
    "geral.estado": "id long, sigla string, descricao string",
    "vendas.categoria": "id long, descricao string",
    "vendas.produto": (
        "id long, nome string, id_categoria long, valor_venda decimal(18,2)"
    ),
    "vendas.nota_fiscal": (
        "id long, data_venda timestamp, id_cliente long, id_vendedor long"
    ),
    "vendas.item_nota_fiscal": (
        "id_nota_fiscal long, id_produto long, quantidade long, "
        "valor_unitario decimal(18,2), valor_venda_real decimal(18,2)"
    ),
}


def short_name(table: str) -> str:
    return table.rsplit(".", 1)[-1]


class SalesSource:
    """One frame per source table, with the columns of ``SOURCE_SCHEMAS``.

    Frames are attributes named like the tables, without their schema; each is
    opened when it is first used. Sellers are natural persons; ``vendedor_pf`` may
    name another frame for them and is the table of natural persons otherwise.
    """

    def __init__(self, spark: SparkSession, open_table: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._open_table = dict(open_table)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._open_table:
            raise AttributeError(name)
        frame = self._open_table[name]()
        setattr(self, name, frame)
        return frame

    @property
    def sellers(self) -> DataFrame:
        return self.vendedor_pf if "vendedor_pf" in self._open_table else self.pessoa_fisica


def from_frames(spark: SparkSession, frames: Mapping[str, DataFrame]) -> SalesSource:
    """A source over frames that are already open."""
    return SalesSource(spark, {name: lambda df=df: df for name, df in frames.items()})


def from_parquet(spark: SparkSession, folder: str) -> SalesSource:
    """A source dump, one Parquet table per source table, read without inference."""

    def reader(name: str, schema: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(schema).parquet(f"{folder}/{name}")

    return SalesSource(spark, {
        short_name(table): reader(short_name(table), schema)
        for table, schema in SOURCE_SCHEMAS.items()
    })
