"""Helpers that several operators share: staging, label components, word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.staging import stage

#: One document in five is held out from every training step.
FOLDS = 5

#: The white space that separates words: space and \t \n \v \f \r, nothing else.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

WORD = r"[^\x20\x09-\x0D]+"

#: Stands after every text where texts are joined; within texts it is read as a blank.
END = b"\x00"
_LOWER = bytes(b" "[0] if c == 0 else c + 32 if 65 <= c <= 90 else c for c in range(256))

#: Bytes of text hashed at once; bounds the memory of a task, not the length of a text.
WINDOW_BYTES = 1 << 21

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NEXT_WORD = np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str = "doc_id"):
    """crc32 of the id as text, modulo five; 0 is held out."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash factor and of its inverse modulo 2**64."""
    if _powers["n"] < n:
        n = max(n, WINDOW_BYTES + 64)
        inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
        up, down = np.full(n, _FACTOR), np.full(n, inverse)
        up[0] = down[0] = 1
        _powers.update(n=n, up=np.cumprod(up), down=np.cumprod(down))
    return _powers["up"], _powers["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and the bounds of each; null is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.fill_null("")
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], (bounds - bounds[0]).astype(np.int64)


#: Bytes of a batch that Spark sends to Python at most, but for longer rows.
BATCH_BYTES = 8 << 20
_BATCH_BYTES, _SPARKS_OWN = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Let batches for Python end at BATCH_BYTES, not only at a number of rows, so that
    long texts do not fill a task's memory. A limit that the session names is left alone.
    Stays set, since frames are run later."""
    if spark.conf.get(_BATCH_BYTES) == _SPARKS_OWN:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def slices(batches: Iterable[pa.RecordBatch], column: int, most: int = 4 << 20):
    """Slices of batches with about ``most`` bytes of text; a longer text is alone. Freed
    memory goes back to the system at the end: Python workers outlive their tasks."""
    for batch in batches:
        sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        part = np.cumsum(sizes) // most
        bounds = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(sizes)]
        for first, last in zip(bounds[:-1], bounds[1:]):
            yield batch.slice(first, last - first)
    pa.default_memory_pool().release_unused()


def words_and_ends(column: pa.Array, pattern) -> list[bytes]:
    """Words of all texts of a column, A-Z lower-cased, and END after each text, by one
    pass of a compiled pattern of bytes that also matches END. Null is empty."""
    texts = column.cast(pa.binary()).fill_null(b"").to_pylist()
    joined = END.join(t.translate(_LOWER) for t in texts)
    return pattern.findall(joined + END) if texts else []


def word_spans(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; a text boundary also ends a word."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def distinct_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number of every word among the different ones, and these, by exact comparison."""
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    letters = raw[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    bounds = np.r_[0, np.cumsum(ends - starts)]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary.to_pylist()


def expand(parts: Sequence[bytes], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-byte values of the numbered parts one after another, and the bounds of each."""
    flat = np.frombuffer(b"".join(parts), np.uint32)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    first = np.r_[0, np.cumsum(size)][:-1]
    sizes = size[number]
    bounds = np.r_[0, np.cumsum(sizes)]
    return flat[np.arange(bounds[-1]) + np.repeat(first[number] - bounds[:-1], sizes)], bounds


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, by prefix sums over windows of the buffer."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + WINDOW_BYTES, "right")))
        begin, finish = starts[first], ends[last - 1]
        up, down = _power_tables(int(finish - begin) + 1)
        sums = np.zeros(finish - begin + 1, np.uint64)
        np.cumsum((raw[begin:finish].astype(np.uint64) + np.uint64(1)) * up[: finish - begin],
                  out=sums[1:])
        s, e = starts[first:last] - begin, ends[first:last] - begin
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words of a sequence of word hashes."""
    m = len(hashes) - n + 1
    total = hashes[:m].copy()
    for k in range(1, n):
        total = total * _NEXT_WORD + hashes[k : m + k]
    return mix(total)


def smallest_reachable(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that links reach, for every linked node.

    ``edges`` has long columns ``a`` and ``b``. Large-star and small-star rounds as
    joins with per-node minima, so a node with very many links is pre-aggregated and
    its rows can be split. Each round is a written table; only one count per round
    comes to the driver. Nulls and loops are ignored.
    """
    now = stage(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}_edges",
    )
    before = None
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (
            both.join(low, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("low", "a").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"),
                    F.col("low").alias("b"))
            .where("a <> b").distinct()
        )
        now = stage(small, f"{name}_stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"{name}: components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
