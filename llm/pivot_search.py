"""Exact top-k search by inner product through a table of pivot distances (operator 11).

The distance of every vector to some pivots is computed once. For a query and a vector the
largest difference of their distances to a pivot bounds their own distance from below, so
the inner product, which is (|q|^2 + |x|^2 - d^2) / 2, from above. Candidates are evaluated
in the order of that bound until it falls below the k-th best score: the rest cannot win.

The table is sorted by nearest pivot and distance from it and cut into blocks of equal
size, so a region with a third of all vectors is many blocks. A query first searches its
own block, which gives a score that others must reach. Queries are cut into spans of the
same order. A span meets a block only if the bounds of both leave a chance; then only such
vectors and queries are sent as their own bounds leave. What meets is bounded on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.operators.keys import dense_keys
from salesmart.operators.staging import stage

#: Whole numbers below this are exact in doubles.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Search:
    """k: results of a query. scale: components become floor(scale * x). every: rows whose
    id it divides are queries. pivots: of each vector length. sample: vectors that the
    pivots are chosen from; they only steer the order, all vectors are searched. block:
    vectors of a task. span: positions whose queries share a task, at most so many.
    chunks: tasks that the pairs of spans and blocks of one length are dealt to."""

    k: int = 5
    scale: int = 256
    every: int = 50
    pivots: int = 24
    sample: int = 1024
    block: int = 16_384
    span: int = 16 * 16_384
    chunks: int = 64


# --- bounds and scores ------------------------------------------------------------

def _squares(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x * x).sum(-1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """[vector, pivot]; infinite where squares overflow."""
    out = np.empty((len(x), len(pivots)))
    with np.errstate(over="ignore"):
        for i, p in enumerate(pivots):
            out[:, i] = np.sqrt(_squares(x - p))
    return out


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """At most n distinct vectors, each the farthest from those before it."""
    chosen = [0]
    gap = distances(x, x[:1])[:, 0]
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def best_possible(q_square, x_square, least):
    """Upper bound of the inner product of vectors at a distance of ``least`` or more, with
    room for rounding; infinite where the numbers are too large to tell."""
    with np.errstate(invalid="ignore", over="ignore"):
        room = 1e-9 * (q_square + x_square) + 1e-3
        bound = (q_square + x_square - least * least) / 2 + room
        bound = np.minimum(bound, np.sqrt(q_square) * np.sqrt(x_square) + room)
    return np.where(np.isnan(bound), np.inf, bound)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 64 bits the nearest such number."""
    if not x.size:
        return np.zeros(len(x), np.int64)
    if len(q) * np.abs(q).max() * np.abs(x).max() < EXACT:
        return (x @ q).astype(np.int64)
    own = [int(c) for c in q]
    found = (sum(a * int(b) for a, b in zip(own, row)) for row in x)
    return np.array([max(-LONG - 1, min(LONG, s)) for s in found], np.int64)


@dataclass
class Rows:
    """Vectors of one length with their position, id and distances to the pivots."""

    position: np.ndarray
    ids: np.ndarray
    x: np.ndarray
    table: np.ndarray
    square: np.ndarray


def search(q: int, queries: Rows, rows: Rows, k: int, reach: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Row numbers and scores of the best k for query number ``q`` that reach ``reach``,
    and how many were evaluated. Ties go to the smaller id."""
    with np.errstate(invalid="ignore"):
        least = np.abs(rows.table - queries.table[q]).max(1, initial=0.0)
    bound = best_possible(queries.square[q], rows.square, least)
    live = np.flatnonzero((bound >= reach) & (rows.position != queries.position[q]))
    live = live[np.argsort(-bound[live], kind="stable")]
    best, value, done, step = live[:0], np.zeros(0, np.int64), 0, 64
    while done < len(live) and (len(best) < k or bound[live[done]] >= value[-1]):
        some = live[done : done + step]
        best = np.concatenate([best, some])
        value = np.concatenate([value, scores(queries.x[q], rows.x[some])])
        order = np.lexsort((rows.ids[best], ~value))[:k]
        best, value = best[order], value[order]
        done, step = done + len(some), 2 * step
    return best, value, done


# --- rows between Arrow and numpy ----------------------------------------------------

def _packed(x: np.ndarray) -> list[bytes]:
    """Two bytes a component where they suffice, else eight."""
    small = np.abs(x).max(1, initial=0.0) < 1 << 15
    return [(row.astype(np.int16) if s else row).tobytes() for row, s in zip(x, small)]


def _unpacked(column: list[bytes], size: int) -> np.ndarray:
    out = np.empty((len(column), size))
    for i, raw in enumerate(column):
        out[i] = np.frombuffer(raw, np.int16 if len(raw) == 2 * size else np.float64)
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), width)


def _rows(table: pa.Table) -> Rows:
    size = table.column("size")[0].as_py()
    width = len(table.column("table")[0])
    return Rows(table.column("position").to_numpy(), table.column("vec_id").to_numpy(),
                _unpacked(table.column("vector").to_pylist(), size),
                _matrix(table.column("table"), width), table.column("square").to_numpy())


_INDEX = ("vec_id long, size int, vector binary, table array<double>, square double, "
          "region int, near double")


def _index(pivots: dict[int, np.ndarray], search_: Search):
    def run(batches):
        for batch in batches:
            for ids, x in _by_size(batch, search_.scale):
                size = x.shape[1]
                table = distances(x, pivots.get(size, np.zeros((0, size))))
                near = table.argmin(1) if table.shape[1] else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.full(len(x), size), pa.int32()),
                     pa.array(_packed(x), pa.binary()),
                     pa.ListArray.from_arrays(np.arange(len(x) + 1) * table.shape[1], table.ravel()),
                     pa.array(_squares(x)), pa.array(near, pa.int32()),
                     pa.array(table.min(1, initial=np.inf))],
                    ["vec_id", "size", "vector", "table", "square", "region", "near"])
    return run


def _by_size(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and floored components of the vectors of each length."""
    lengths = batch.column(1).value_lengths().to_numpy()
    for size in np.unique(lengths):
        part = batch.take(pa.array(np.flatnonzero(lengths == size)))
        for first in range(0, part.num_rows, 2048):
            some = part.slice(first, 2048)
            x = some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, size)
            yield some.column(0).to_numpy(), np.floor(x * scale)


# --- tasks ------------------------------------------------------------------------------

_HOME = ("size int, block long, position long, vec_id long, vector binary, table array<double>, "
         "square double, reach double, low array<double>, high array<double>")


def _extent(table: np.ndarray) -> tuple[list, list]:
    """Smallest and largest distance to each pivot; not-a-number stays."""
    return table.min(0).tolist(), table.max(0).tolist()


def _search_home(search_: Search):
    """Of a block: its extent (position null), and its queries with the score they reach."""
    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        size, block = group.column("size")[0].as_py(), group.column("block")[0].as_py()
        low, high = _extent(rows.table)
        out = [dict(size=size, block=block, square=float(rows.square.max()), low=low, high=high)]
        vectors = group.column("vector")
        for q in np.flatnonzero(rows.ids % search_.every == 0):
            _, value, _ = search(q, rows, rows, search_.k, -np.inf)
            reach = float(np.nextafter(float(value[-1]), -np.inf)) if len(value) == search_.k else -np.inf
            out.append(dict(size=size, block=block, position=rows.position[q], vec_id=rows.ids[q],
                            vector=vectors[q].as_py(), table=rows.table[q].tolist(),
                            square=float(rows.square[q]), reach=reach))
        return pa.Table.from_pylist(out, _HOME_ARROW)
    return run


_DOUBLES = pa.list_(pa.float64())
_HOME_ARROW = pa.schema([
    ("size", pa.int32()), ("block", pa.int64()), ("position", pa.int64()), ("vec_id", pa.int64()),
    ("vector", pa.binary()), ("table", _DOUBLES), ("square", pa.float64()), ("reach", pa.float64()),
    ("low", _DOUBLES), ("high", _DOUBLES)])


def _span_extent(group: pa.Table) -> pa.Table:
    table = _matrix(group.column("table"), len(group.column("table")[0]))
    low, high = _extent(table)
    return pa.table({
        "size": group.column("size").slice(0, 1), "span": group.column("span").slice(0, 1),
        "low": pa.array([low], _DOUBLES), "high": pa.array([high], _DOUBLES),
        "square": pa.array([group.column("square").to_numpy().max()]),
        "reach": pa.array([group.column("reach").to_numpy().min()])})


_FOUND = "position long, query_id long, vec_id long, score long"


def _search_block(search_: Search):
    def run(queries: pa.Table, group: pa.Table) -> pa.Table:
        names = ["position", "query_id", "vec_id", "score"]
        out = [np.zeros(0, np.int64)] * 4
        if queries.num_rows and group.num_rows:
            asked, rows, reach = _rows(queries), _rows(group), queries.column("reach").to_numpy()
            found = []
            for q in range(len(asked.ids)):
                best, value, _ = search(q, asked, rows, search_.k, reach[q])
                found.append((np.full(len(best), asked.position[q]), np.full(len(best), asked.ids[q]),
                              rows.ids[best], value))
            out = [np.concatenate(c) for c in zip(*found)]
        return pa.table(dict(zip(names, out)))
    return run


def _has_chance(q: str, x: str):
    """Whether the extents of two sides leave a score of ``{q}reach``: where the distances
    to a pivot lie apart by a gap, so do all vectors of the sides."""
    gap = F.array_max(F.expr(
        f"transform(sequence(0, size({q}low)), i -> if(i = 0, 0D, greatest(0D, "
        f"element_at({q}low, i) - element_at({x}high, i), element_at({x}low, i) - element_at({q}high, i))))"))
    both = F.col(f"{q}square") + F.col(f"{x}square")
    bound = (both - gap * gap) / 2 + 1e-9 * both + 1e-3
    # Not-a-number is larger than any number, so what cannot be told goes on.
    return bound >= F.col(f"{q}reach")


def _named(df: DataFrame, prefix: str, *keys: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keys else prefix + c) for c in df.columns])


# --- the operator -----------------------------------------------------------------------

def top_k(vectors: DataFrame, settings: Search = Search(), id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of every query.

    Components x become floor(scale * x), x as double. Queries are the rows whose id
    ``every`` divides, candidates all rows but the query's own; a row that repeats an id is
    a candidate like others, and a query with a result of its own. Ties go to the smaller
    id. Vectors are compared with those of their own length, empty ones by a score of 0.
    Rows take no part where the id or the vector is null, or a component is null, not
    finite, or not finite when scaled. A score beyond 64 bits is the nearest such number.
    An empty table gives an empty result. Other columns are not read.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                          F.col(vector_column).cast("array<double>").alias("embedding"))
    sound = F.expr(
        "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null "
        f"and not isnan(x) and abs(x * {float(settings.scale)}D) < double('infinity'))")
    rows = rows.where(sound)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample).collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["embedding"]), []).append(row["embedding"])
    pivots = {size: farthest_first(np.floor(np.array(x, np.float64).reshape(len(x), size) * settings.scale),
                                   settings.pivots) for size, x in by_size.items()}
    placed = dense_keys(rows.mapInArrow(_index(pivots, settings), _INDEX), "position",
                        ["size", "region", "near", "vec_id"])
    cut = (F.col("position") - 1) / settings.block
    index = placed.select("position", "vec_id", "size", "vector", "table", "square",
                          F.floor(cut).alias("block"))
    home = stage(index.groupBy("size", "block").applyInArrow(_search_home(settings), _HOME),
                 "search_home")
    asked = home.where("position is not null").drop("low", "high").withColumn(
        "span", F.floor((F.col("position") - 1) / settings.span))
    extents = home.where("position is null").select("size", "block", "low", "high", "square")
    meeting = stage(_meeting(asked, extents, settings), "search_meeting")
    # Each side is thinned by its own bounds before it is sent.
    queries = _named(asked.drop("block").withColumn("low", F.col("table")).withColumn(
        "high", F.col("table")), "q_", "size", "span") \
        .join(meeting.select("size", "span", "block", "x_low", "x_high", "x_square"), ["size", "span"]) \
        .where(_has_chance("q_", "x_"))
    candidates = _named(index.withColumn("low", F.col("table")).withColumn("high", F.col("table")),
                        "x_", "size", "block") \
        .join(meeting.select("size", "span", "block", "q_low", "q_high", "q_square", "q_reach"),
              ["size", "block"]).where(_has_chance("q_", "x_"))
    key = ["size", "span", "block"]
    own = ["position", "vec_id", "vector", "table", "square"]
    found = (
        queries.select(*key, *[F.col(f"q_{c}").alias(c) for c in (*own, "reach")]).groupBy(*key)
        .cogroup(candidates.select(*key, *[F.col(f"x_{c}").alias(c) for c in own]).groupBy(*key))
        .applyInArrow(_search_block(settings), _FOUND)
    )
    place = F.row_number().over(
        Window.partitionBy("position").orderBy(F.desc("score"), F.asc("vec_id"))).alias("rank")
    return found.select("*", place).where(F.col("rank") <= settings.k) \
        .select("query_id", "rank", "vec_id", "score")


def _meeting(asked: DataFrame, extents: DataFrame, settings: Search) -> DataFrame:
    """Pairs of a span and a block, with their extents, that may hold a result."""
    spans = asked.groupBy("size", "span").applyInArrow(
        _span_extent, "size int, span long, low array<double>, high array<double>, "
                      "square double, reach double")
    # Dealt to chunks of blocks, so one length is not one task.
    chunk = F.pmod(F.xxhash64("block"), F.lit(settings.chunks))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(settings.chunks - 1).cast("long")))
    return (
        _named(spans, "q_", "size", "span").withColumn("chunk", every)
        .join(_named(extents, "x_", "size", "block").withColumn("chunk", chunk), ["size", "chunk"])
        .where(_has_chance("q_", "x_")).drop("chunk")
    )


def oracle_sql(settings: Search = Search()) -> str:
    """DuckDB SQL: every query against every row."""
    return f"""
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({settings.scale} * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM sound q JOIN sound x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
  WHERE q.vec_id % {settings.every} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {settings.k}"""
