"""Days whose source rows changed after they were loaded.

A run loads the days it is asked for. An invoice that is entered for an earlier day, a line
that is corrected or taken out, would stay unseen until its day is run again. So every load
stores a digest of its days' source rows: how many, and the sum of their hashes, which does
not depend on their order. Comparing these with the source's own, one row per day each,
names the days to load again.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.operators.staging import stage
from salesmart.plans.fact import invoices, lines_of
from salesmart.sources.tables import SalesSource

_DAY = schemas.STORE_DAY.name
_HASHED = ["id_nota", "id_cliente", "id_vendedor", "id_produto", "quantidade",
           "valor_unitario", "valor_venda_real"]


def day_digests(
    src: SalesSource, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Per day its lines of known products and the sum of their hashes.

    Lines are summed per invoice on the shuffle that joins them to their headers, so an
    invoice or day with a third of all lines sends a few rows per task.
    """
    headers = invoices(src, first, last)
    known = None
    if first is not None and last is not None:
        known = headers = stage(headers, "headers")
    products = src.produto.select(F.col("id").alias("id_produto"))
    own = [c for c in _HASHED if c not in ("id_cliente", "id_vendedor")]
    # A header's hash counts once per line. Sums of 20 digits a line stay within 38.
    line = F.xxhash64(*own).cast("decimal(20,0)")
    header = F.xxhash64("id_nota", "id_cliente", "id_vendedor").cast("decimal(20,0)")
    per_invoice = (
        lines_of(src, known).join(products, "id_produto", "left_semi")
        .groupBy("id_nota").agg(F.count(F.lit(1)).alias("n"), F.sum(line).alias("hashes"))
    )
    return (
        headers.join(per_invoice, "id_nota").groupBy(_DAY)
        .agg(F.sum("n").alias("linhas"),
             F.sum((F.col("hashes") + F.col("n").cast("decimal(12,0)") * header).cast("decimal(34,0)"))
             .cast("decimal(38,0)").alias("digest"))
    )


def changed_days(source: DataFrame, stored: DataFrame) -> DataFrame:
    """(data_venda, linhas_fonte, linhas_gravadas): days whose digests differ, also those
    that only one side has. One row per day on either side."""
    mine = source.select(_DAY, F.col("linhas").alias("linhas_fonte"), F.col("digest").alias("_fonte"))
    theirs = stored.select(_DAY, F.col("linhas").alias("linhas_gravadas"), F.col("digest").alias("_gravado"))
    return (
        mine.join(theirs, _DAY, "full")
        .where(~(F.col("_fonte").eqNullSafe(F.col("_gravado"))
                 & F.col("linhas_fonte").eqNullSafe(F.col("linhas_gravadas"))))
        .select(_DAY, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("linhas_fonte", "linhas_gravadas")])
    )


def in_ranges(days: list[date]) -> list[tuple[date, date]]:
    """Consecutive days as ranges."""
    out: list[tuple[date, date]] = []
    for day in sorted(days):
        if out and day - out[-1][1] == timedelta(days=1):
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out
