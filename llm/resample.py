"""Importance resampling of documents toward a target corpus (operator 12).

Every run of one to three words is a feature, hashed to a bucket by its crc32. A bucket's
gain is the log ratio of its share in the target to its share in the documents; a
document's weight is the sum of the gains of its features. Gumbel noise from a digest of
the id makes the highest scores a sample without replacement in proportion to the
exponential of the weights.

The texts of a batch are joined with sentinels and one regex pass finds all words and
sentinels. Searching the document offsets gives each word its document, and runs that
cross from one into the next are masked before the buckets are counted. No run is ever
built as a string: the crc32 of joined strings follows from those of the parts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from salesmart.operators.keys import dense_keys
from salesmart.operators.staging import stage

#: Words in lower-cased UTF-8: digits, letters and every byte of a character beyond ASCII.
_WORD_OR_END = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")

#: Fixed value: the reflected polynomial of crc32.
_POLYNOMIAL = np.uint32(0xEDB88320)
#: Byte lengths whose shift is one table; longer ones are put together from powers of two.
_SHORT = 64


@dataclass(frozen=True)
class Resampling:
    """words: longest run. buckets: features are hashed to so many. least_words: shorter
    documents are never drawn. percent: share of the others that is drawn. seed: of the
    noise. per_unit: weights and noise are whole numbers of 1 / per_unit nats."""

    words: int = 3
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 5
    seed: int = 42
    per_unit: int = 1000


# --- crc32 of joined strings ----------------------------------------------------

def _by_byte(value: np.ndarray, table: np.ndarray, row) -> np.ndarray:
    """A linear map of 32-bit values, given by its images of each byte."""
    out = table[row, 0, value & 255]
    for k in (1, 2, 3):
        out ^= table[row, k, (value >> np.uint32(8 * k)) & 255]
    return out


@lru_cache(maxsize=1)
def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Images of each byte when 0 to 63 zero bytes follow, and 64, 128, 256 ... ones."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ (_POLYNOMIAL * (step & np.uint32(1)))
    short = np.empty((_SHORT, 4, 256), np.uint32)
    for k in range(4):
        short[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, _SHORT):
        short[n] = (short[n - 1] >> np.uint32(8)) ^ step[short[n - 1] & 255]
    half = short[_SHORT // 2][None]
    long = []
    for _ in range(40):
        half = _by_byte(half, half, 0)
        long.append(half)
    return short, long


def followed(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What crc32 values contribute once ``length`` more bytes follow."""
    short, long = _shift_tables()
    out = _by_byte(crc, short, length % _SHORT)
    rest = length // _SHORT
    for table in long:
        if not rest.any():
            break
        odd = (rest & 1).astype(bool)
        out[odd] = _by_byte(out[odd], table, 0)
        rest = rest >> 1
    return out


_BLANK = np.uint32(zlib.crc32(b" "))


# --- features of a batch --------------------------------------------------------

def features(column: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First the number of the first word of every text, and of the end; then for runs of
    1, 2 ... words the crc32 of the run at each word, and whether one text holds it."""
    tokens = common.words_and_ends(column, _WORD_OR_END)
    length = np.fromiter(map(len, tokens), np.int64, len(tokens))
    crc = np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens))
    # No word of one byte has the sentinel's crc32.
    ends = (length == 1) & (crc == np.uint32(zlib.crc32(common.END)))
    offsets = np.r_[0, np.cumsum(~ends)[ends]].astype(np.int64)
    length, crc = length[~ends], crc[~ends]
    text = np.searchsorted(offsets, np.arange(len(crc)), "right") - 1
    yield offsets, text
    run = crc
    yield run, np.ones(len(run), bool)
    blank = np.ones(1, np.int64)
    for k in range(1, words):
        run = followed(run[:-1], blank) ^ _BLANK
        run = followed(run, length[k:]) ^ crc[k:]
        yield run, text[k:] == text[:-k]


def _counts(settings: Resampling):
    def run(batches):
        total = np.zeros(settings.buckets, np.int64)
        for batch in common.slices(batches, 0):
            found = features(batch.column(0), settings.words)
            next(found)
            for crc, whole in found:
                total += np.bincount(crc[whole] % np.uint32(settings.buckets),
                                     minlength=settings.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, settings: Resampling, text_column: str = "text") -> np.ndarray:
    """Features per bucket over all texts. Tasks send at most a row per bucket, and so
    many rows come to the driver."""
    rows = (
        texts.select(F.col(text_column).alias("text"))
        .mapInArrow(_counts(settings), "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    out = np.zeros(settings.buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray, settings: Resampling) -> np.ndarray:
    """Log ratio of the smoothed shares of each bucket, floored to 1 / per_unit nats."""
    own_all, target_all = float(own.sum() + settings.buckets), float(target.sum() + settings.buckets)
    ratios = [float(t + 1) * own_all / (float(s + 1) * target_all)
              for s, t in zip(own.tolist(), target.tolist())]
    return np.array([math.floor(settings.per_unit * math.log(r)) for r in ratios], np.int64)


def _weights(gain: np.ndarray, settings: Resampling):
    def run(batches):
        for batch in common.slices(batches, 1):
            found = features(batch.column(1), settings.words)
            offsets, _ = next(found)
            n = np.diff(offsets)
            total, count = np.zeros(offsets[-1] + 1, np.int64), np.zeros(len(n), np.int64)
            for k, (crc, whole) in enumerate(found):
                own = np.where(whole, gain[crc % np.uint32(settings.buckets)], 0)
                total[1 : len(own) + 1] += own
                count += np.maximum(n - k, 0)
            sums = np.cumsum(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(count),
                 pa.array(sums[offsets[1:]] - sums[offsets[:-1]])],
                ["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(doc_id, settings: Resampling):
    """Gumbel noise of an id, floored to 1 / per_unit nats; a null id is the empty text."""
    named = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(named.cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(float(-settings.per_unit)) * F.log(-F.log(share))).cast("long")


def resample(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling(),
             id_column: str = "doc_id", text_column: str = "text",
             target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), a row per input row.

    ``rank`` counts the drawn documents from 1 by score, equal scores by id, null ids
    last; it is null where a document is not drawn. Null texts and texts without words
    have no feature and weight 0, and are too short to be drawn. A repeated row is a
    document like others. An empty target leaves the gains to the documents' own counts;
    an empty table gives an empty result. Other columns are not read. Texts of any length
    are read whole; a task holds a few MB of texts at a time, or one longer text.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).alias("text"))
    gain = gains(bucket_counts(docs, settings), bucket_counts(target, settings, target_text), settings)
    scored = stage(
        docs.mapInArrow(_weights(gain, settings),
                        "doc_id long, n_words long, n_features long, weight long")
        .withColumn("score", F.col("weight") + noise(F.col("doc_id"), settings)),
        "resample_scored")
    long_enough = F.col("n_words") >= settings.least_words
    drawn = settings.percent * scored.where(long_enough).count() // 100
    # Numbered by sort tasks, so neither a window nor a limit puts them in one task.
    ordered = dense_keys(scored.where(long_enough), "position", [
        F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")])
    rank = F.when(F.col("position") <= drawn, F.col("position")).alias("rank")
    return ordered.select(*scored.columns, rank).unionByName(
        scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))


def oracle_sql(settings: Resampling = Resampling()) -> str:
    """DuckDB SQL of the contract's columns. crc32 is folded over the bytes of each
    distinct run, eight bits a byte."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    runs = " UNION ALL ".join(
        f"SELECT corpus, row_no, unnest(list_transform(range(1, len(words) - {k} + 2), "
        f"lambda i: array_to_string(words[i : i + {k - 1}], ' '))) AS feature FROM split"
        for k in range(1, settings.words + 1))
    step = "xor(crc >> 8, one_byte[(xor(crc, byte) & 255) + 1])"
    return f"""
WITH RECURSIVE bit(n, code, crc) AS (
  SELECT 0, code, code FROM range(256) r(code)
  UNION ALL SELECT n + 1, code, xor(crc >> 1, {int(_POLYNOMIAL)} * (crc & 1)) FROM bit WHERE n < 8
), steps AS (SELECT list(crc ORDER BY code) AS one_byte FROM bit WHERE n = 8
), texts AS (
  SELECT 'own' AS corpus, row_number() OVER () AS row_no, doc_id, text FROM documents
  UNION ALL SELECT 'target', row_number() OVER (), NULL, text FROM benchmark
), split AS (SELECT corpus, row_no, doc_id, {words} AS words FROM texts
), runs AS ({runs}
), hexed AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM runs)
), bytes AS (
  SELECT feature, list_transform(range(0, len(h) // 2),
    lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT) AS b FROM hexed
), bucketed AS (
  SELECT feature, xor(list_reduce(b, lambda crc, byte: {step}, 4294967295::BIGINT), 4294967295)
    % {settings.buckets} AS bucket FROM bytes, steps
), placed AS (SELECT corpus, row_no, bucket FROM runs JOIN bucketed USING (feature)
), counted AS (
  SELECT bucket, count(*) FILTER (corpus = 'own') AS s, count(*) FILTER (corpus = 'target') AS t
  FROM placed GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counted
), gained AS (
  SELECT bucket, floor({settings.per_unit} * ln((t + 1)::DOUBLE * (all_s + {settings.buckets})
    / ((s + 1)::DOUBLE * (all_t + {settings.buckets}))))::BIGINT AS gain FROM counted, totals
), weighed AS (
  SELECT row_no, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM placed JOIN gained USING (bucket) WHERE corpus = 'own' GROUP BY row_no
), scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{settings.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM split LEFT JOIN weighed USING (row_no) WHERE corpus = 'own'
), noisy AS (
  SELECT doc_id, n_words, n_features, weight,
    weight + floor(-{settings.per_unit} * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {settings.least_words}
    ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
    count(*) FILTER (n_words >= {settings.least_words}) OVER () AS eligible FROM noisy
)
SELECT doc_id, n_words::BIGINT AS n_words, n_features, weight, score,
  CASE WHEN n_words >= {settings.least_words} AND place <= {settings.percent} * eligible // 100
    THEN place END AS rank FROM ranked"""
