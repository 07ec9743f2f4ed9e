"""Near-duplicate embeddings by E8 lattice hashing (operator 6).

A table projects unit vectors to eight dimensions at random and decodes them to the
nearest point of the E8 lattice, the densest packing there is in eight dimensions: its
cells are rounder than a grid's, so near vectors share one more often. Each vector also
probes the neighbouring cells nearest to it. Vectors of one label that meet in a cell are
compared by exact cosine in blocks; a pair that meets in several cells is counted in one
of them. Cells send counts and a spanning set of links, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from salesmart.operators.staging import stage


#: Steps a unit in which vectors and projections are rounded before they are hashed.
GRID = 2.0**20
#: Links that wait at most, but for those of one cell, until their vectors' codes are computed.
WAITING = 200_000


@dataclass(frozen=True)
class Lattice:
    """threshold: least cosine of a link. tables: independent projections. probes:
    neighbouring cells per table. scale: larger is finer cells. block: vectors compared
    at once; a cell of more is joined as pairs of blocks in several tasks."""

    threshold: float = 0.93
    tables: int = 10
    probes: int = 3
    scale: float = 0.75
    block: int = 2048
    seed: int = 11


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    pairs = [(i, j, a, b) for i, j in combinations(range(8), 2) for a, b in product((1, -1), repeat=2)]
    out = np.zeros((len(pairs), 8))
    for row, (i, j, a, b) in zip(out, pairs):
        row[i], row[j] = a, b
    halves = np.array([s for s in product((0.5, -0.5), repeat=8) if np.sum(np.array(s) < 0) % 2 == 0])
    return np.vstack([out, halves])


def _even_sum(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    if len(odd):
        gap = x[odd] - near[odd]
        worst = np.abs(gap).argmax(1)
        near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest lattice points: integers with an even sum, or such moved by a half."""
    whole, half = _even_sum(x), _even_sum(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=4)
def _projections(lattice: Lattice, size: int) -> np.ndarray:
    """[size, 8 * tables]: the scaled projections of all tables, in whole steps of the grid."""
    draws = [np.random.default_rng([lattice.seed, t, size]).standard_normal((size, 8))
             for t in range(lattice.tables)]
    return np.rint(np.hstack(draws) * (lattice.scale * GRID))


def _code(points: np.ndarray, table: int) -> np.ndarray:
    out = np.full(len(points), table + 1, np.uint64)
    doubled = np.rint(2 * points).astype(np.int64).view(np.uint64)
    for k in range(8):
        out = common.mix(out * np.uint64(0x9E3779B97F4A7C15) + doubled[:, k])
    return out.view(np.int64)


def cells(unit: np.ndarray, lattice: Lattice) -> np.ndarray:
    """[vector, table, 1 + probes]: codes of the own cell and the probed ones."""
    n, size = unit.shape
    out = np.empty((n, lattice.tables, 1 + lattice.probes), np.int64)
    short = minimal_vectors()
    # On the grid all sums are exact in any order: a vector has the same codes in any batch.
    projected = np.rint(unit * GRID) @ _projections(lattice, size) / GRID**2
    for t in range(lattice.tables):
        x = projected[:, 8 * t : 8 * t + 8]
        own = nearest_e8(x)
        out[:, t, 0] = _code(own, t)
        if lattice.probes:
            toward = (x - own) @ short.T
            near = np.argpartition(-toward, lattice.probes, axis=1)[:, : lattice.probes]
            for p in range(lattice.probes):
                out[:, t, 1 + p] = _code(own + short[near[:, p]], t)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(column: pa.Array) -> np.ndarray:
    x = _matrix(column)
    # Scaled by the largest component first: squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _deal(lattice: Lattice):
    """A row per vector and distinct cell."""
    def run(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                for first in range(0, part.num_rows, 1024):
                    some = part.slice(first, 1024)
                    codes = cells(_unit(some.column(2)), lattice).reshape(some.num_rows, -1)
                    codes.sort(axis=1)
                    fresh = np.ones(codes.shape, bool)
                    fresh[:, 1:] = codes[:, 1:] != codes[:, :-1]
                    row, _ = np.nonzero(fresh)
                    out = some.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [*out.columns[:2], pa.array(codes[fresh]),
                         pa.array(np.full(len(row), size), pa.int32())],
                        ["node", "label", "cell", "size"])
    return run


def _first_meeting(a: np.ndarray, b: np.ndarray, cell: int) -> np.ndarray:
    """Whether ``cell`` is the smallest code that both rows of codes hold."""
    both = (a[:, :, :, None] == b[:, :, None, :]).any(3)
    smallest = np.where(both, a, np.iinfo(np.int64).max).min((1, 2))
    return smallest == cell


@dataclass
class _Links:
    """Links of one cell, or of a pair of its blocks: rows of its vectors in the bucket,
    and both ends of every link as positions among them."""

    cell: int
    rows: np.ndarray
    left: np.ndarray
    right: np.ndarray


def _compare(lattice: Lattice):
    """(node, n, root) of the cells of a bucket: linked vectors that a cell counts, and the
    smallest node of the vectors that its links connect."""
    def run(group: pa.Table) -> pa.Table:
        names = ("task", "cell", "node", "m", "block")
        task, cell, ids, weight, block = (group.column(c).to_numpy() for c in names)
        across = group.column("across").to_numpy()
        vectors = group.column("embedding").combine_chunks()
        found, waiting, links = [np.zeros((0, 3), np.int64)], [], 0
        order = np.argsort(task, kind="stable")
        cuts = np.flatnonzero(np.diff(task[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows) > 1:
                own = _links(_unit(vectors.take(pa.array(rows))), rows, block[rows],
                             bool(across[rows[0]]), int(cell[rows[0]]), lattice)
                if len(own.left):
                    waiting.append(own)
                    links += len(own.left)
            if links >= WAITING:
                found += _counted(waiting, vectors, ids, weight, lattice)
                waiting, links = [], 0
        found += _counted(waiting, vectors, ids, weight, lattice)
        node, n, root = np.concatenate(found).T
        return pa.table({"node": node, "n": n, "root": root})
    return run


def _links(unit, rows, block, across: bool, cell: int, lattice: Lattice) -> _Links:
    """The links of a cell, or those ``across`` two of its blocks, of which one may be empty;
    only the linked vectors are kept."""
    left, right = [], []
    for first in range(0, len(rows), 512):
        i, j = np.nonzero(unit[first : first + 512] @ unit.T >= lattice.threshold)
        i = i + first
        keep = i < j
        if across:
            keep &= block[i] != block[j]
        left.append(i[keep])
        right.append(j[keep])
    left, right = np.concatenate(left), np.concatenate(right)
    linked = np.unique(np.r_[left, right])
    return _Links(cell, rows[linked], np.searchsorted(linked, left), np.searchsorted(linked, right))


def _counted(waiting: list[_Links], vectors: pa.Array, ids, weight, lattice: Lattice) -> list[np.ndarray]:
    """Rows (node, n, root) of the linked vectors of cells. The codes of all their vectors
    are computed together, once for a vector of several cells."""
    if not waiting:
        return []
    _, first, place = np.unique(ids[np.concatenate([x.rows for x in waiting])],
                                return_index=True, return_inverse=True)
    rows = np.concatenate([x.rows for x in waiting])[first]
    sizes = pc.list_value_length(vectors.take(pa.array(rows))).to_numpy(zero_copy_only=False)
    codes = np.empty((len(rows), lattice.tables, 1 + lattice.probes), np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for some in np.split(at, range(1024, len(at), 1024)):
            codes[some] = cells(_unit(vectors.take(pa.array(rows[some]))), lattice)
    out, done = [], 0
    for x in waiting:
        own = codes[place[done : done + len(x.rows)]]
        done += len(x.rows)
        out.append(_cell(x, own, ids[x.rows], weight[x.rows]))
    return out


def _cell(links: _Links, codes, ids, weight) -> np.ndarray:
    """Rows (node, n, root) of the linked vectors of one cell."""
    counts, root, left, right = np.zeros(len(ids), np.int64), ids.copy(), links.left, links.right
    for at in range(0, len(left), 20_000):
        i, j = left[at : at + 20_000], right[at : at + 20_000]
        own = _first_meeting(codes[i], codes[j], links.cell)
        counts += np.bincount(i[own], weight[j[own]], len(ids)).astype(np.int64)
        counts += np.bincount(j[own], weight[i[own]], len(ids)).astype(np.int64)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        if (before == root).all():
            break
    return np.stack([ids, counts, root], axis=1)


def near_duplicates(
    vectors: DataFrame, lattice: Lattice = Lattice(), id_column: str = "vec_id",
    vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per input row.

    Vectors of equal, non-null labels and equal length link when they meet in a cell and
    their cosine in double precision is at least the threshold; equal vectors always link.
    A vector that is null, empty, zero or holds a null or non-finite component, and one
    with a null label, has no links and is its own component. Rows that repeat an id are
    rows like others; a null id is never the smallest. Other columns are not read.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast("array<double>").alias("embedding"))
    sound = F.expr(
        "label is not null and embedding is not null and size(embedding) > 0 "
        "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(embedding, x -> x <> 0)")
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    # Equal vectors are one node, numbered where it is written. Rows find theirs by 128 bits
    # of hashes of label and vector; the others have no second half, match nothing and are
    # dealt by the first.
    rows = rows.withColumn("high", F.when(F.col("sound"), F.xxhash64("label", "embedding"))
                           .otherwise(F.xxhash64("vec_id", "label", "embedding")))
    rows = rows.withColumn("low", F.when(F.col("sound"), F.xxhash64(F.lit(1), "label", "embedding")))
    digest = ["high", "low"]
    distinct = stage(
        rows.where("sound").groupBy(*digest, "label", "embedding")
        .agg(F.count("*").alias("m"), F.min("vec_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()), "lattice_vectors")
    dealt = stage(distinct.select("node", "label", "embedding").mapInArrow(
        _deal(lattice), "node long, label string, cell long, size int"), "lattice_cells")
    key = ["label", "size", "cell"]
    met = dealt.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1")
    dealt = dealt.join(met, key).withColumn("blocks", F.ceil(F.col("members") / lattice.block))
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))
    dealt = dealt.withColumn("block", own).withColumn("other", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    # Many small cells share a task: about 20,000 rows each.
    buckets = max(64, distinct.count() * lattice.tables * (1 + lattice.probes) // 20_000)
    found = stage(
        dealt.join(distinct.select("node", "embedding", "m"), "node")
        .select("node", "m", "embedding", "cell", "block",
                (F.col("low") < F.col("high")).alias("across"),
                F.xxhash64("label", "size", "cell", "low", "high").alias("task"))
        .withColumn("bucket", F.pmod("task", F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_compare(lattice), "node long, n long, root long"), "lattice_links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    reach = common.smallest_reachable(
        found.select(F.col("node").alias("a"), F.col("root").alias("b")), "lattice")
    named = distinct.select("node", "first_id").join(reach, "node")
    lowest = named.groupBy("component").agg(F.min("first_id").alias("lowest"))
    labelled = (
        distinct.select(*digest, "node", "m", "first_id").join(counts, "node", "left")
        .join(named.select("node", "component").join(lowest, "component"), "node", "left")
        .select(*digest, (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                F.coalesce("lowest", "first_id").alias("component_id")))
    out = rows.select("vec_id", *digest).join(labelled, digest, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
