"""Hand-made source tables that hold one case of every kind.

Last second of a day; two addresses; an address with no district; a person who is
both natural and legal with no natural name; a person who is neither; a natural
person who never bought; no seller; a legal person as seller; a sale outside the
calendar; unit price zero; a product with no category; two cities of one name.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from salesmart.sources.tables import SOURCE_SCHEMAS, SalesSource, from_frames, short_name


def _money(*values):
    return [Decimal(v) for v in values]


ROWS = {
    "geral.estado": [(1, "SP", "Sao Paulo"), (2, "RJ", "Rio de Janeiro")],
    "geral.cidade": [
        (1, "Santos", 1), (2, "Niteroi", 2), (3, "Bom Jesus", 1), (4, "Bom Jesus", 2),
    ],
    "geral.bairro": [(1, "Centro", 1), (2, "Icarai", 2), (3, "Sul", 3), (4, "Norte", 4)],
    "geral.pessoa": [(i,) for i in range(1, 8)],
    "geral.pessoa_fisica": [
        (1, "Ana", "111"), (2, "Bruno", "222"), (5, None, "555"),
        (6, "Vera", "666"), (7, "Zeca", "777"),
    ],
    "geral.pessoa_juridica": [(3, "Acme", "333"), (5, "Cinco Ltda", "5550")],
    "geral.endereco": [
        (1, 1, 1, "11000"), (2, 2, 2, "24000"), (3, 2, 3, "12000"),
        (4, 3, None, "00000"), (5, 5, 4, "28000"),
    ],
    "vendas.categoria": [(1, "Papelaria")],
    "vendas.produto": [
        (1, "Caneta", 1, Decimal("10.00")),
        (2, "Caderno", 1, Decimal("25.00")),
        (3, "Brinde", None, Decimal("5.00")),
    ],
    "vendas.nota_fiscal": [
        (100, datetime(2024, 1, 10, 23, 59, 59), 1, 6),
        (101, datetime(2024, 1, 10, 8, 0), 2, 6),
        (102, datetime(2024, 2, 5), 3, 6),
        (103, datetime(2024, 2, 6), 4, None),
        (104, datetime(2014, 12, 31), 1, 6),
        (105, datetime(2024, 2, 7), 5, 3),
    ],
    "vendas.item_nota_fiscal": [
        (100, 1, 2, *_money("10.00", "9.00")),
        (100, 2, 1, *_money("20.00", "22.00")),
        (101, 1, 1, *_money("8.00", "8.00")),
        (102, 2, 5, *_money("25.00", "20.00")),
        (103, 1, 1, *_money("0.00", "5.00")),
        (104, 1, 1, *_money("10.00", "10.00")),
        (105, 2, 1, *_money("25.00", "24.00")),
        (105, 3, 1, *_money("5.00", "5.00")),
    ],
}


def source(spark, **changed) -> SalesSource:
    """The source tables; ``changed`` replaces the rows of some, by short name."""
    return from_frames(spark, {
        short_name(table): spark.createDataFrame(
            changed.get(short_name(table), ROWS[table]), schema
        )
        for table, schema in SOURCE_SCHEMAS.items()
    })


def rows(df) -> list[tuple]:
    """Rows as plain tuples in a fixed order, money as text."""
    plain = [tuple(str(v) if isinstance(v, Decimal) else v for v in row) for row in df.collect()]
    return sorted(plain, key=repr)


def expect(*tuples) -> list[tuple]:
    return sorted(tuples, key=repr)
