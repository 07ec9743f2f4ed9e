"""Quality rules on tokeniser fertility (operator 1).

Public vocabularies measure every text: characters per token, the share of tokens that
fall back to bytes, and the entropy of its tokens. Text unlike its language breaks into
short tokens, bytes, or the same few tokens over and over. Each language has rejection
bands from the tails of its own documents, drawn smoothly toward those of its script the
fewer they are; documents without a language have the bands of their script.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from llm.bpe_codec import chunks
from llm.language_id import CHUNK_CHARS, char_tables
from salesmart.operators.staging import stage

#: Words whose tokens a worker keeps, and the longest word that is kept.
KEPT_WORDS, KEPT_LENGTH = 250_000, 64
SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_OTHER_SPACE = re.compile(r"[^\S ]")
MEASURES = ("piece_chars", "byte_chars", "fallback", "entropy")


@dataclass(frozen=True)
class Rules:
    """fewest words, and most percent of repeated words, of the base rules. reach: how
    many times the distance of the near quartile a band extends from the median; each
    side has its own. prior_rows: weight, in documents, of the script in the bands of a
    language, and of ``wide`` in those of a script. wide, least: spread of a script of
    which nothing is known, and the smallest spread, as a share of the median (of one for
    fallback and entropy). safe: (low, high) of each measure between which nothing is
    rejected: many characters per token, few bytes and many different tokens are no fault.
    """

    fewest_words: int = 50
    repeated_percent: int = 50
    reach: float = 5.0
    prior_rows: int = 20
    wide: float = 0.1
    least: float = 0.005
    safe: tuple[tuple[float, float], ...] = ((4.0, 8.0), (4.0, 8.0), (0.0, 0.05), (0.9, 1.0))


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Vocabularies:
    """Tokens of words under a piece vocabulary with byte fallback, and token counts under
    a byte-level one; each word as if one space stood before it."""

    def __init__(self, pieces: str, ranks: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=table, special_tokens={})
        # Whether a token of the byte vocabulary begins a word.
        self.begins = np.zeros(max(table.values()) + 1, bool)
        self.begins[[i for token, i in table.items() if token[:1] == b" "]] = True
        self.cache: dict[bytes, tuple[bytes, int]] = {}

    def of_words(self, words: list[bytes]) -> list[tuple[bytes, int]]:
        """Of different words: the piece tokens, four bytes each, and the number of byte tokens."""
        if len(self.cache) > KEPT_WORDS:
            self.cache.clear()
        missing = [w for w in words if w not in self.cache]
        texts = [w.decode() for w in missing]
        pieces = self.pieces.encode(texts, num_threads=1)
        ends = np.cumsum([0, *map(len, pieces)]) * 4
        flat = np.fromiter(chain.from_iterable(pieces), np.uint32, int(ends[-1]) // 4).tobytes()
        tokens = [flat[first:last] for first, last in pairwise(ends.tolist())]
        self.cache.update(zip(missing, zip(tokens, self._byte_tokens(texts))))
        found = [self.cache[w] for w in words]
        for word in missing:
            if len(word) > KEPT_LENGTH:
                del self.cache[word]
        return found

    def _byte_tokens(self, words: list[str]) -> list[int]:
        """Byte tokens of each word after a space. The split pattern joins no word with the
        next, so they are encoded together, but those that hold other white space."""
        joined = "".join(" " + w for w in words)
        if _OTHER_SPACE.search(joined):
            plain = [not _OTHER_SPACE.search(w) for w in words]
            rest = iter(self._byte_tokens([w for w, fits in zip(words, plain) if fits]))
            return [next(rest) if fits else len(self.bytes.encode_ordinary(" " + w))
                    for w, fits in zip(words, plain)]
        tokens = np.array(self.bytes.encode_ordinary(joined), np.int64)
        first = np.flatnonzero(self.begins[tokens])
        assert len(first) == len(words)
        return np.diff(np.r_[first, len(tokens)]).tolist()


@lru_cache(maxsize=2)
def vocabularies(pieces: str, ranks: str) -> Vocabularies:
    return Vocabularies(pieces, ranks)


def _repeated(number: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Per text, its words in 3-word windows that occur twice or more in it. ``number``
    tells words apart; ``cut`` bounds the words of each text."""
    covered = np.zeros(len(number), bool)
    if len(number) > 3:
        n, wide = int(number.max()) + 1, number.astype(np.int64)
        window = wide[:-1] * n + wide[1:]
        if n >= 1 << 20:
            window = np.unique(window, return_inverse=True)[1]
        window = window[:-1] * n + wide[2:]
        text = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        whole = np.flatnonzero(text[:-2] == text[2:])
        order = whole[np.argsort(window[whole], kind="stable")]
        # Equal windows stand together, in order of their texts.
        same = (window[order[1:]] == window[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        twice = order[np.r_[False, same] | np.r_[same, False]]
        for k in range(3):
            covered[twice + k] = True
    return _sums(covered, cut)


def _sums(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Sums of whole numbers between bounds."""
    return np.diff(np.r_[0, np.cumsum(values, dtype=np.int64)][cut])


def _duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def _entropy(ids: np.ndarray) -> float:
    """Entropy of the tokens as a share of that of as many different tokens; 1 for one."""
    if len(ids) < 2:
        return 1.0
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(counts * np.log(counts)).sum() / np.log(len(ids)))


@lru_cache(maxsize=1)
def _scripts() -> np.ndarray:
    """Of each code point: script of a letter (0 for no letter). Scripts that the table of
    languages does not list have the first word of their characters' names."""
    out = char_tables()[0].astype(np.uint16)
    numbers: dict[str, int] = {}
    first = int(out.max()) + 1
    for c in np.flatnonzero(out == 1):
        word = unicodedata.name(chr(c), "OTHER").split()[0]
        out[c] = first + numbers.setdefault(word, len(numbers))
    return out


def _script(texts: list[str]) -> list[int]:
    """The script of most letters of each text; 0 without letters."""
    scripts = _scripts()
    n = int(scripts.max()) + 1
    counts = np.zeros((len(texts), n), np.int64)
    for first, last in chunks(texts, CHUNK_CHARS):
        ends = np.cumsum([0, *map(len, texts[first:last])])
        joined = "".join(texts[first:last])
        for begin in range(0, len(joined), CHUNK_CHARS):
            part = joined[begin : begin + CHUNK_CHARS]
            found = scripts[np.frombuffer(part.encode("utf-32-le"), np.uint32)]
            for i, (a, b) in enumerate(pairwise(np.clip(ends - begin, 0, len(part)).tolist())):
                if a < b:
                    counts[first + i] += np.bincount(found[a:b], minlength=n)
    counts[:, 0] = 0
    return counts.argmax(1).tolist()


_ROW = ("doc_id long, grp string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, n_piece_tokens long, n_byte_tokens long, piece_chars double, "
        "byte_chars double, fallback double, entropy double, script long")


def _measure(own: Vocabularies, texts: list[str]) -> list[list]:
    """Columns of counts and measures. Different words of the texts are tokenised and
    looked up once; the rest is done on arrays of their numbers."""
    raw, bounds = common.text_buffer(pa.array(texts, pa.string()))
    starts, ends = common.word_spans(raw, bounds)
    cut = np.searchsorted(starts, bounds)
    number, words = common.distinct_words(raw, starts, ends)
    tokens, byte_tokens = zip(*own.of_words(words)) if words else ((), ())
    # The tokens of all words in order, and the bounds of those of each text.
    ids, after = common.expand(tokens, number)
    ids = ids.astype(np.int64)
    own_ids = after[cut]
    n_pieces = np.diff(own_ids).tolist()
    n_bytes = _sums(np.array(byte_tokens, np.int64)[number], cut).tolist()
    points = np.fromiter((len(w.decode()) for w in words), np.int64, len(words))
    chars = _sums(points[number], cut).tolist()
    fallback = _sums(own.is_byte[ids], own_ids).tolist()
    symbols = np.diff(np.searchsorted(np.flatnonzero(_IS_SYMBOL[raw]), bounds)).tolist()
    return [
        np.diff(cut).tolist(), chars, symbols, list(map(_duplicate_lines, texts)),
        _repeated(number, cut).tolist(), n_pieces, n_bytes,
        [c / n if n else None for c, n in zip(chars, n_pieces)],
        [c / n if n else None for c, n in zip(chars, n_bytes)],
        [c / n if n else None for c, n in zip(fallback, n_pieces)],
        [_entropy(ids[a:b]) if a < b else None for a, b in pairwise(own_ids.tolist())], _script(texts)]


def measure(docs: DataFrame, paths: tuple[str, str] | None = None, id_column: str = "doc_id",
            text_column: str = "text", group_column: str = "lang") -> DataFrame:
    """A row of counts and measures per input row; null texts are empty."""
    pieces, ranks = paths or default_vocabularies()

    def run(batches):
        own = vocabularies(pieces, ranks)
        for batch in common.slices(batches, 2):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for first, last in chunks(texts):
                columns = _measure(own, texts[first:last])
                yield pa.RecordBatch.from_arrays(
                    [c.slice(first, last - first) for c in batch.columns[:2]]
                    + [pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    names = [part.split()[0] for part in _ROW.split(", ")]
    kinds = [pa.int64() if part.endswith(" long") else pa.float64() for part in _ROW.split(", ")[2:]]
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(group_column).cast("string").alias("grp"),
        F.col(text_column).alias("text")).mapInArrow(run, _ROW)


def level(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """With ``level``, the entropy as if every text had one length.

    Entropy as a share falls with the logarithm of the tokens, so long sound texts would
    hide the low entropy of shorter junk. The slope is that of the sound documents of the
    script, drawn toward that within all scripts the fewer they are; to the driver come
    three numbers per script.
    """
    tokens = F.log(F.col("n_piece_tokens").cast("double"))
    fits = measured.where(~_failed(rules)).groupBy("script").agg(
        F.count("*").alias("n"), F.covar_pop("entropy", tokens).alias("xy"),
        F.var_pop(tokens).alias("xx")).collect()
    every = sum(r["n"] * (r["xy"] or 0.0) for r in fits) \
        / (sum(r["n"] * (r["xx"] or 0.0) for r in fits) + rules.prior_rows)
    slope = F.lit(every)
    for r in fits:
        own = (r["n"] * (r["xy"] or 0.0) + rules.prior_rows * every) \
            / (r["n"] * (r["xx"] or 0.0) + rules.prior_rows)
        slope = F.when(F.col("script") == r["script"], F.lit(own)).otherwise(slope)
    return measured.withColumn("level", F.col("entropy") - slope * tokens)


def bands(levelled: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(grp, script, and low_ and high_ of each measure): of every script with documents
    that pass the base rules under a null group, and of every group with such documents,
    beside the script of most of them. Those of entropy are for ``level``."""
    sound = levelled.where(~_failed(rules)).withColumn("entropy", F.col("level"))
    quantiles = [F.percentile_approx(m, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(m)
                 for m in MEASURES]
    scripts = sound.groupBy("script").agg(F.count("*").alias("n"), *quantiles)
    groups = sound.where("grp is not null").groupBy("grp").agg(
        F.mode("script", True).alias("script"), F.count("*").alias("n"), *quantiles)

    def toward(own, other):
        return (F.col("n") * own + rules.prior_rows * other) / (F.col("n") + rules.prior_rows)

    def scale(m):
        return F.col(m)[1] if m.endswith("chars") else F.lit(1.0)

    def tails(m):
        return F.col(m)[1] - F.col(m)[0], F.col(m)[2] - F.col(m)[1]

    def edges(m, mid, down, up):
        # A band holds the median of its own documents, however few there are.
        least, q = rules.least * scale(m), F.col(m)[1]
        return [(F.least(mid, q) - rules.reach * F.greatest(down, least)).alias(f"low_{m}"),
                (F.greatest(mid, q) + rules.reach * F.greatest(up, least)).alias(f"high_{m}")]

    # Languages are drawn toward the mean tails of the languages of their script.
    within = groups.groupBy("script").agg(F.sum("n").alias("n"), *(
        (F.sum(F.col("n") * tail) / F.sum("n")).alias(f"{side}_{m}")
        for m in MEASURES for side, tail in zip(("down", "up"), tails(m))))
    known = within.join(scripts.drop("n"), "script").select("script", *(
        c for m in MEASURES for c in (
            F.col(m)[1].alias(f"mid_{m}"), toward(F.col(f"down_{m}"), rules.wide * scale(m)).alias(f"down_{m}"),
            toward(F.col(f"up_{m}"), rules.wide * scale(m)).alias(f"up_{m}"))))
    languages = groups.join(known, "script").select("grp", "script", *(
        c for m in MEASURES for c in edges(m, toward(F.col(m)[1], F.col(f"mid_{m}")), *(
            toward(tail, F.col(f"{side}_{m}")) for side, tail in zip(("down", "up"), tails(m))))))
    alone = scripts.select(F.lit(None).cast("string").alias("grp"), "script", *(
        c for m in MEASURES for c in edges(m, F.col(m)[1], *(
            toward(tail, rules.wide * scale(m)) for tail in tails(m)))))
    return alone.union(languages)


def _failed(rules: Rules):
    return (F.col("n_words") < rules.fewest_words) \
        | (100 * F.col("n_repeat_words") > rules.repeated_percent * F.col("n_words"))


def judge(docs: DataFrame, rules: Rules = Rules(), paths: tuple[str, str] | None = None,
          id_column: str = "doc_id", text_column: str = "text", group_column: str = "lang") -> DataFrame:
    """Counts, measures, base_failed, rejected_by and kept, a row per input row.

    A null or empty text has no words and fails the base rules. A null group, or one
    without a document that passes these, is judged by the bands of the text's script.
    ``rejected_by`` names the measures outside their bands. Repeated rows and null ids are
    kept; other columns are not read; texts and words of any length are measured whole.
    """
    measured = stage(measure(docs, paths, id_column, text_column, group_column), "fertility")
    levelled = level(measured, rules)
    limits = stage(bands(levelled, rules), "fertility_bands")
    edges = [f"{side}_{m}" for m in MEASURES for side in ("low", "high")]
    own = limits.where("grp is not null").drop("script")
    script = limits.where("grp is null").select("script", *(F.col(e).alias(f"script_{e}") for e in edges))
    joined = levelled.join(own, "grp", "left").join(script, "script", "left")
    outside = []
    for m, (safe_low, safe_high) in zip(MEASURES, rules.safe):
        low, high = (F.coalesce(f"{side}_{m}", f"script_{side}_{m}") for side in ("low", "high"))
        value = F.col("level" if m == "entropy" else m)
        wrong = ((value < low) & (F.col(m) < safe_low)) | ((value > high) & (F.col(m) > safe_high))
        outside.append(F.when(wrong, F.lit(m)))
    return joined.withColumn("base_failed", _failed(rules)) \
        .withColumn("rejected_by", F.array_compact(F.array(*outside))) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)) \
        .drop("script", "level", *edges, *(f"script_{e}" for e in edges))
