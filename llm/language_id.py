"""Languages of texts and of their spans (operator 8).

The script of a word, by Unicode ranges, narrows the languages it can be in. A word's
score under a language is the log-likelihood of its character trigrams. The best path of
languages over the words of a text, with a penalty for each switch, labels its spans.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from llm.bpe_codec import chunks

#: First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF),
              (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF),
               (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F)],
    "bengali": [(0x0980, 0x09FF)],
    "gurmukhi": [(0x0A00, 0x0A7F)],
    "gujarati": [(0x0A80, 0x0AFF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "telugu": [(0x0C00, 0x0C7F)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
UNDETERMINED = "und"
#: Characters labelled at once: about 150 bytes of arrays each.
CHUNK_CHARS = 300_000


@dataclass(frozen=True)
class Settings:
    """buckets: hashed trigrams a language counts. penalty: nats a switch costs.
    script_share: least share of a language's letters in a script that makes it a
    candidate there. smoothing: added to every trigram count."""

    buckets: int = 1 << 16
    penalty: float = 24.0
    script_share: float = 0.01
    smoothing: float = 0.1


@lru_cache(maxsize=1)
def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: script of a letter (0 for no letter), and its lower case."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for number, blocks in enumerate(SCRIPTS.values(), 2):
        for first, last in blocks:
            script[first : last + 1] = number
    for c in range(0x110000):
        if not chr(c).isalpha():
            script[c] = 0
        else:
            script[c] = script[c] or 1  # a letter of a script that is not listed
            low = chr(c).lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return script, lower


@dataclass
class Words:
    """Words (runs of letters) of some texts, and the hashed trigrams of each."""

    starts: np.ndarray   # in the joined text
    ends: np.ndarray
    script: np.ndarray
    grams: np.ndarray    # one per letter and one more per word
    gram_starts: np.ndarray
    cut: np.ndarray      # first word of each text, and the number of words
    offset: np.ndarray   # first character of each text


def words_of(texts: list[str], buckets: int, keys: bool = False) -> Words:
    """``keys`` leaves the trigrams as they are packed, not hashed to buckets."""
    script_of, lower = char_tables()
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.r_[0, np.cumsum(sizes)]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    script = script_of[points]
    letter = script > 0
    edge = np.zeros(len(points) + 1, bool)
    edge[offset] = True
    start = letter.copy()
    start[1:] &= ~letter[:-1] | edge[1:-1]
    end = letter.copy()
    end[:-1] &= ~letter[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    # Each word with two marks before and one after it: one trigram per letter and one more.
    length = ends - starts
    gram_starts = np.r_[0, np.cumsum(length + 1)]
    own = np.repeat(np.arange(len(starts)), length + 1)
    at = np.arange(gram_starts[-1]) - gram_starts[own]
    low = lower[points].astype(np.uint64) if len(points) else np.zeros(1, np.uint64)

    def char(shift):
        place = at + shift
        inside = (place >= 0) & (place < length[own])
        return np.where(inside, low[np.clip(starts[own] + place, 0, len(low) - 1)], np.uint64(1))

    grams = (char(-2) << np.uint64(42)) ^ (char(-1) << np.uint64(21)) ^ char(0)
    if not keys:
        grams = (common.mix(grams) % np.uint64(buckets)).astype(np.int64)
    return Words(starts, ends, script[starts] if len(starts) else np.zeros(0, np.uint8),
                 grams, gram_starts,
                 np.searchsorted(starts, offset), offset)


@dataclass
class Model:
    """languages, log-likelihoods [trigram, language], candidates [script, language]."""

    languages: list[str]
    scores: np.ndarray
    candidates: np.ndarray
    settings: Settings


def train(labelled: DataFrame, settings: Settings = Settings(),
          text_column: str = "text", lang_column: str = "lang") -> Model:
    """Counts trigrams per language over all rows with a text and a language.

    Counts are added up on the executors; to the driver come at most ``buckets`` and the
    scripts per language.
    """
    n_scripts = len(SCRIPTS) + 2

    def run(batches):
        for batch in common.slices(batches, 0):
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            counts: dict[str, np.ndarray] = {}
            for first, last in chunks(texts, CHUNK_CHARS):
                words = words_of(texts[first:last], settings.buckets)
                n_words = np.diff(words.cut)
                own = np.repeat(np.arange(last - first), n_words)
                kinds = sorted(set(langs[first:last]))
                number = np.array([kinds.index(x) for x in langs[first:last]], np.int64)
                gram_lang = np.repeat(number[own], np.diff(words.gram_starts))
                for k, lang in enumerate(kinds):
                    one = counts.setdefault(lang, np.zeros(settings.buckets + n_scripts, np.int64))
                    one[: settings.buckets] += np.bincount(words.grams[gram_lang == k],
                                                           minlength=settings.buckets)
                    mine = number[own] == k
                    one[settings.buckets :] += np.bincount(
                        words.script[mine], (words.ends - words.starts)[mine],
                        n_scripts).astype(np.int64)
            for lang, one in counts.items():
                held = np.flatnonzero(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(held), pa.string()), pa.array(held), pa.array(one[held])],
                    ["lang", "feature", "c"])

    rows = (
        labelled.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
        .where("text is not null and lang is not null")
        .mapInArrow(run, "lang string, feature long, c long")
        .groupBy("lang", "feature").agg(F.sum("c").alias("c")).toPandas()
    )
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((settings.buckets + n_scripts, len(languages)))
    for k, lang in enumerate(languages):
        mine = rows[rows["lang"] == lang]
        counts[mine["feature"].to_numpy(), k] = mine["c"].to_numpy()
    grams, letters = counts[: settings.buckets], counts[settings.buckets :]
    scores = np.log((grams + settings.smoothing)
                    / (grams.sum(0) + settings.smoothing * settings.buckets))
    candidates = letters >= settings.script_share * np.maximum(letters.sum(0), 1)
    return Model(languages, scores.astype(np.float32), candidates & (letters > 0), settings)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """[word, language]; zero for all where no language uses the script."""
    if not len(words.starts):
        return np.zeros((0, len(model.languages)))
    scores = np.add.reduceat(model.scores[words.grams], words.gram_starts[:-1], axis=0)
    fits = model.candidates[words.script]
    scores = np.where(fits, scores, scores.min(1, keepdims=True) - model.settings.penalty)
    scores[~fits.any(1)] = 0
    return scores.astype(np.float64)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best path of one text."""
    n, k = scores.shape
    stay = np.empty((n, k), np.int64)
    value = scores[0].copy()
    for t in range(1, n):
        top = int(value.argmax())
        switch = value[top] - penalty
        stay[t] = np.where(value >= switch, np.arange(k), top)
        value = np.maximum(value, switch) + scores[t]
    path = np.empty(n, np.int64)
    path[-1] = value.argmax()
    for t in range(n - 1, 0, -1):
        path[t - 1] = stay[t, path[t]]
    return path


def paths(scores: np.ndarray, cut: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word of every text.

    A text stays in its best single language ``d`` if no run of words gains more than
    half the penalty under another language: a path of k other runs gains at most k times
    that and pays at least k - 1 switches. Only other texts need the recursion.
    """
    path = np.zeros(len(scores), np.int64)
    texts = np.flatnonzero(np.diff(cut))
    if not len(texts):
        return path
    first, size = cut[texts], np.diff(cut)[texts]
    best = np.add.reduceat(scores, first, axis=0).argmax(1)
    own = np.repeat(np.arange(len(texts)), size)
    path[:] = best[own]
    gain = scores - scores[np.arange(len(scores)), path][:, None]
    far = 4 * np.abs(gain).max() * size.max() + 1
    sums = np.cumsum(gain, axis=0)
    sums -= (sums[first] - gain[first])[own]
    before = sums - gain
    low = np.minimum.accumulate(before - (far * own)[:, None], axis=0) + (far * own)[:, None]
    mixed = np.maximum.reduceat((sums - low).max(1), first) > penalty / 2 - 1e-3
    for i in np.flatnonzero(mixed):
        span = slice(first[i], first[i] + size[i])
        path[span] = viterbi(scores[span], penalty)
    return path


def label(texts: list[str], model: Model) -> list[tuple[str, float, list[dict]]]:
    """Language, its share of the letters, and spans (lang, start, end) of each text.

    Letters of a script that the language does not use count for no language, so a text
    in an unknown script has score 0.
    """
    words = words_of(texts, model.settings.buckets)
    if not model.languages:
        return [(UNDETERMINED, 0.0, [])] * len(texts)
    path = paths(word_scores(words, model), words.cut, model.settings.penalty)
    letters = words.ends - words.starts
    known = letters * model.candidates[words.script, path]
    k = len(model.languages)
    out = []
    for i in range(len(texts)):
        first, last = words.cut[i], words.cut[i + 1]
        if first == last:
            out.append((UNDETERMINED, 0.0, []))
            continue
        own = path[first:last]
        share = np.bincount(own, known[first:last], k)
        turns = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        ends = np.r_[turns[1:], last - first] - 1
        top = int(share.argmax())
        out.append((model.languages[top], float(share[top] / letters[first:last].sum()),
                    [{"lang": model.languages[own[a]],
                      "start": int(words.starts[first + a] - words.offset[i]),
                      "end": int(words.ends[first + b] - words.offset[i])}
                     for a, b in zip(turns, ends)]))
    return out


_SPANS = "array<struct<lang: string, start: int, end: int>>"


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id",
             text_column: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, spans) and the ``carry`` columns, a row per input row.

    ``spans`` cover the words; positions are code points, end exclusive. A null text, one
    without a letter, and any text under a model without languages is ``und`` with score
    0 and no span. Ties, and texts in a script that no language uses (score 0), go to the
    language that sorts first. Repeated rows and null ids
    are kept; other columns are not read; texts of any length are labelled whole.
    """
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in common.slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in chunks(texts, CHUNK_CHARS):
                found = label(texts[first:last], model)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()),
                     pa.array([f[2] for f in found], kind), *[part.column(i) for i in place]],
                    ["doc_id", "lang_pred", "score", "spans", *carry])

    # The text goes to Python once, even if it is carried.
    others = [c for c in carry if c != text_column]
    place = [1 if c == text_column else 2 + others.index(c) for c in carry]
    common.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("read"),
                       *others)
    kinds = "".join(f", `{c}` {rows.dtypes[i][1]}" for c, i in zip(carry, place))
    return rows.mapInArrow(
        run, f"doc_id long, lang_pred string, score double, spans {_SPANS}{kinds}")


def train_on_folds(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from the documents that are not held out."""
    return train(docs.where(common.fold() != 0), settings)
