"""Toxicity of texts after noisy-channel deobfuscation (operator 2).

Writers hide words by look-alike characters, spacing and repetition. A suspicious word is
a lattice: each character may stand for itself, for a letter it resembles, for nothing
(a separator or a repeat). White space between short tokens is a separator or the end of
a word, so runs of them are split into words by the same lattice. A character trigram model of the corpus and the costs of the
channel weigh the paths; Viterbi finds the best. The restored text is scored by evidence
of words and word beginnings learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from llm.bpe_codec import chunks
from llm.language_id import CHUNK_CHARS, words_of
from salesmart.operators.staging import stage

#: Letters that a character stands for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
    "*": "aeiou", "#": "h",
}
#: Characters that may separate the letters of a word.
SEPARATORS = ".-_*~'`^,/"
#: Costs of the channel in nats.
REPLACE, HIDE, SEPARATE, REPEAT, DOUBLE, KEEP = 0.6, 2.5, 0.4, 0.2, 2.5, 4.0
#: White space inside a word next to a token of two or three characters; and the cost of
#: a trigram from which such a token does not look like a word.
BROKEN, STRANGE = 2.5, 5.0
#: Words whose restored form a worker keeps, and the longest that is kept; stretches of
#: one sign are folded before the lattice in longer ones.
KEPT_WORDS, LATTICE_LENGTH = 400_000, 48

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_ODD = re.compile(r"[^\W\d_](?:[^\w\s]|_)+[^\W\d_]|[^\W\d_][\d@$!|+(*#€£]+[^\W\d_]|[\d@$!|+(][^\W\d_]{2}"
                  r"|[^\W\d_]{2}[\d@$!|+]$|(.)\1\1|([^\W\d_])\2")
_OUTER = ".,;:?\"'()[]{}<>"
#: Longest token of a run whose white space may be a separator.
SHORT = 3
_START = "\x01\x01"
_RUN = re.compile("[1-4]{2,}")
#: Kinds of tokens of which a run is spaced out, see Kinds; and the mark of words that tell.
SIGN, LETTER, ODD, TELLS = 2, 3, 4, 8
_PAIR, _TRIPLE = re.compile(r"(.)\1"), re.compile(r"(.)\1\1")


@dataclass(frozen=True)
class Settings:
    """buckets: hashed character n-grams of the language model. most_rows: bound of the
    labelled rows that are read. least: toxic training documents with a feature.
    features: bound of the features kept. evidence: least pessimistic log-odds."""

    buckets: int = 1 << 16
    most_rows: int = 20_000
    least: int = 3
    features: int = 20_000
    evidence: float = 2.2


# --- the character language model ------------------------------------------------

@dataclass
class CharModel:
    """Counts of hashed trigrams and of their first two characters."""

    three: np.ndarray
    two: np.ndarray

    def __post_init__(self):
        self.kept: dict[tuple[str, str, str], float] = {}

    def cost(self, a: str, b: str, c: str) -> float:
        """-log P(c | a, b), smoothed."""
        found = self.kept.get((a, b, c))
        if found is None:
            key = np.array([_code(a, b, c)], np.uint64)
            n3 = self.three[int(common.mix(key)[0] % np.uint64(len(self.three)))]
            key = np.array([_code("\x01", a, b)], np.uint64) ^ np.uint64(1 << 63)
            n2 = self.two[int(common.mix(key)[0] % np.uint64(len(self.two)))]
            found = self.kept[a, b, c] = -math.log((n3 + 0.02) / (n2 + 1.0))
        return found


def _code(a: str, b: str, c: str) -> int:
    return (ord(a) << 42) ^ (ord(b) << 21) ^ ord(c)


def char_model(docs: DataFrame, settings: Settings = Settings(), text_column: str = "text") -> CharModel:
    """Counts the trigrams of the words of all texts. The executors add them up; to the
    driver come two tables of at most ``buckets`` rows."""
    n = settings.buckets

    def run(batches):
        three, two = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in common.slices(batches, 0):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for first, last in chunks(texts, CHUNK_CHARS):
                words = words_of(texts[first:last], n, keys=True)
                three += np.bincount((common.mix(words.grams) % np.uint64(n)).astype(np.int64), minlength=n)
                context = (words.grams >> np.uint64(21)) ^ (np.uint64(1) << np.uint64(42)) ^ np.uint64(1 << 63)
                two += np.bincount((common.mix(context) % np.uint64(n)).astype(np.int64), minlength=n)
        both = np.r_[three, two]
        held = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(both[held])], ["k", "c"])

    rows = docs.select(F.col(text_column).alias("text")).where("text is not null") \
        .mapInArrow(run, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).toPandas()
    both = np.zeros(2 * n)
    both[rows["k"].to_numpy()] = rows["c"].to_numpy()
    return CharModel(both[:n], both[n:])


# --- restoring words ----------------------------------------------------------------

def _choices(word: str, i: int) -> list[tuple[str, float]]:
    """(what a character stands for, cost); the empty string is nothing."""
    c = word[i]
    out = [(c, 0.0 if c.isalpha() else KEEP)]
    if not c.isalpha():
        cost = HIDE if c in "*#" else REPLACE
        out += [(x, cost) for x in LOOKALIKES.get(c, "")]
        if c in SEPARATORS:
            out.append(("", SEPARATE))
    if i and word[i - 1] == c:
        run = (i > 1 and word[i - 2] == c) or word[i + 1 : i + 2] == c
        out.append(("", REPEAT if run else DOUBLE))
    return out


def restore(word: str, model: CharModel) -> str:
    """The best path of a word's lattice; a word without letters stays."""
    word = word.lower()
    if len(word) > LATTICE_LENGTH:
        # Long stretches count as three of a sign; the lattice takes any length.
        word = re.sub(r"(.)\1{3,}", r"\1\1\1", word)
    if word.isalpha() and not _TRIPLE.search(word):
        return _single(word, model)
    return _viterbi((_choices(word, i) for i in range(len(word))), model)


def _single(word: str, model: CharModel) -> str:
    """The best path of letters of which none stands three times: only the second of two
    equal ones may be nothing, and each such choice weighs two trigrams against one."""
    full, done, out = f"\x01{word}\x01", 0, []
    for pair in _PAIR.finditer(word):
        x, b, c = full[pair.start()], pair[1], full[pair.end() + 1]
        if DOUBLE + model.cost(x, b, c) < model.cost(x, b, b) + model.cost(b, b, c):
            out.append(word[done : pair.start() + 1])
            done = pair.end()
    return "".join(out) + word[done:]


def _viterbi(arcs, model: CharModel) -> str:
    """The best path through the choices of every character. A space ends a word. Paths
    share their beginnings, so time and space are linear in the length."""
    best: dict[str, tuple] = {_START: (0.0, None)}
    for choices in arcs:
        after: dict[str, tuple] = {}
        for state, (cost, path) in best.items():
            for out, channel in choices:
                total, key, made = cost + channel, state, path
                if out == " ":
                    if state != _START:
                        total, key, made = total + model.cost(state[0], state[1], "\x01"), _START, (path, out)
                elif out:
                    total, key, made = total + model.cost(state[0], state[1], out), state[1] + out, (path, out)
                if key not in after or total < after[key][0]:
                    after[key] = (total, made)
        best = after
    path = min(((cost + model.cost(s[0], s[1], "\x01"), path) for s, (cost, path) in best.items()),
               key=lambda found: found[0])[1]
    text = []
    while path:
        path, out = path
        text.append(out)
    return "".join(reversed(text))


def _run_arcs(tokens: list[str]):
    """Choices of the characters of a run of short tokens and of the space between them."""
    for k, token in enumerate(tokens):
        if k:
            joined = SEPARATE if len(token) == len(tokens[k - 1]) == 1 else BROKEN
            yield [(" ", 0.0), ("", joined)]
        for i, c in enumerate(token):
            choices = _choices(token, i)
            if len(token) > 1 and i in (0, len(token) - 1) and not c.isalnum():
                choices = [*choices, ("", REPLACE)]  # an outer sign may be decoration
            yield choices


def restore_run(tokens: list[str], model: CharModel) -> list[str]:
    """The words that a run of short tokens spells."""
    return _viterbi(_run_arcs([t.lower() for t in tokens]), model).split()


class Kinds(dict):
    """Part of tokens in a run: 0 none; 1 a short word or a separator; 2 one sign that may
    be a letter; 3 one letter; 4 a short token that does not look like a word."""

    def __init__(self, model: CharModel):
        self.model = model

    def __missing__(self, raw: str) -> str:
        found = str(self._kind(raw))
        if len(raw) <= LATTICE_LENGTH:
            self[raw] = found
        return found

    def _kind(self, raw: str) -> int:
        if len(raw) > SHORT + 4:
            return 0
        core = (raw.strip(_OUTER) or raw).lower()
        if len(core) == 2 and not core[1].isalnum():
            core = core.rstrip("!*#")  # 'm!' is one letter and a sign
        if not core or len(core) > SHORT:
            return 0
        if len(core) == 1:
            return 3 if core.isalpha() else 2 if core in LOOKALIKES else int(core in SEPARATORS)
        if core.isalpha():
            full = _START + core + "\x01"
            worst = max(self.model.cost(*full[i : i + 3]) for i in range(len(full) - 2))
            return 4 if worst > STRANGE else 1
        known = all(c.isalpha() or c in LOOKALIKES or c in SEPARATORS for c in core)
        return 4 if known and any(c.isalpha() for c in core) else 0


class Restorer:
    """Normal form of words, with the restored form of suspicious ones, kept per worker."""

    def __init__(self, model: CharModel):
        self.model = model
        self.cache: dict[str, str] = {}
        self.kinds = Kinds(model)

    def __call__(self, text: str) -> list[str]:
        """Restored words in order, lower-cased, without outer punctuation."""
        if len(self.cache) > KEPT_WORDS:
            self.cache.clear()
        if len(self.kinds) > KEPT_WORDS:
            self.kinds.clear()
        cache, raws, out = self.cache, text.split(), []
        for first, last, in_run in self._parts(raws):
            if in_run:
                out += self.run(raws[first:last])
                continue
            for raw in raws[first:last]:
                word = cache.get(raw)
                if word is None:
                    word = self._normal(raw)
                    if len(raw) <= LATTICE_LENGTH:
                        cache[raw] = word
                out.append(word)
        return out

    def _parts(self, raws: list[str]):
        """(first, last, whether spaced): runs of short tokens that look spaced, with one
        short neighbour at each end, and the rest."""
        done = 0
        for run in _RUN.finditer("".join(map(self.kinds.__getitem__, raws))):
            found = spaced([int(kind) for kind in run[0]])
            if found:
                first, last = (run.start() + at for at in found)
                yield done, first, False
                yield first, last, True
                done = last
        yield done, len(raws), False

    def _normal(self, raw: str) -> str:
        core = raw[:-1] if raw[-1] in ",." else raw
        if core.isalpha() and not _PAIR.search(core):
            return core.lower()  # letters of which no two equal ones meet hide nothing
        core = raw
        if _ODD.search(raw):
            # Outer runs of one sign are decoration; a single outer sign may be a letter.
            core = re.sub(r"^([\W_])\1+|([\W_])\2+$", "", raw).strip(".,;:?\"'()[]{}<>")
            if _ODD.search(core) and any(c.isalpha() for c in core):
                core = restore(core, self.model)
        return _EDGE.sub("", core).lower()

    def run(self, tokens: list[str]) -> list[str]:
        """Words of a spaced run. Brackets and stops around a token are no letters of it."""
        return [_EDGE.sub("", w) for w in restore_run([t.strip(_OUTER) or t for t in tokens], self.model)]


def spaced(kinds: list[int]) -> tuple[int, int] | None:
    """Of the kinds of a run of short tokens, the part that looks spaced, if any."""
    odd = [k for k, kind in enumerate(kinds) if kind > 1]
    letters = sum(kind == LETTER for kind in kinds)
    broken = any(kinds[k] > 1 and kinds[k + 1] > 1 and ODD in kinds[k : k + 2]
                 for k in range(len(kinds) - 1))
    if broken or (letters > 1 and sum(1 < kind < ODD for kind in kinds) > 2):
        return max(odd[0] - 1, 0), min(odd[-1] + 2, len(kinds))
    return None


# --- evidence -------------------------------------------------------------------------

def whole(words: set[str]) -> set[str]:
    return {w for w in words if len(w) > 2}


def beginnings(words: set[str]) -> set[str]:
    """The first four to six letters of longer words, with a mark."""
    return {w[:n] + "*" for n in (4, 5, 6) for w in words if len(w) > n}


@dataclass
class Evidence:
    """Log-odds of features, and of a document before any is seen."""

    weights: dict[str, float]
    prior: float


def _count_features(rows: DataFrame, model: CharModel, known: set[str] | None,
                    wanted: set[str] | None) -> DataFrame:
    """(feature, toxic, c): documents with a feature; all of them, or the wanted. The
    features are words, or, given the words ``known`` to tell, beginnings of the others."""
    def run(batches):
        read = Restorer(model)
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(read(text))
                found = whole(words) if known is None else beginnings(words - known)
                counts[toxic].update(found if wanted is None else found & wanted)
            for toxic, own in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(own), pa.string()), pa.array([toxic] * len(own), pa.int32()),
                     pa.array(list(own.values()), pa.int64())], ["feature", "toxic", "c"])

    return rows.select("text", "toxic").mapInArrow(run, "feature string, toxic int, c long") \
        .groupBy("feature", "toxic").agg(F.sum("c").alias("c"))


def learn(docs: DataFrame, labels: DataFrame, model: CharModel, settings: Settings = Settings(),
          id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Evidence:
    """Evidence from labelled documents, each distinct text once.

    At most about ``most_rows`` labelled rows are read, taken by a hash of the id; to the
    driver come at most ``features`` features. Null texts, labels and ids are not used.
    """
    marked = labels.select(F.col(id_column).cast("long").alias("doc_id"),
                           F.col(label_column).cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = marked.count()
    share = min(1.0, settings.most_rows / max(rows, 1))
    # The drawn labels are about ``most_rows`` rows however many there are, 12 bytes each,
    # so they can be sent to every task and no text is shuffled to meet them.
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < share * (1 << 20)
    sample = stage(
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        .where("text is not null").where(drawn).join(F.broadcast(marked.where(drawn)), "doc_id")
        .groupBy(F.sha2("text", 256).alias("digest"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")), "toxicity_labelled")
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    prior = math.log((n1 + 0.5) / (n0 + 0.5))

    def weights(known: set[str] | None) -> dict[str, float]:
        candidates = _count_features(sample.where("toxic = 1"), model, known, None) \
            .where(F.col("c") >= settings.least).orderBy(F.desc("c"), "feature") \
            .limit(settings.features).toPandas()
        toxic = dict(zip(candidates["feature"], candidates["c"].astype(int)))
        clean = _count_features(sample.where("toxic = 0"), model, known, set(toxic)).toPandas()
        other = dict(zip(clean["feature"], clean["c"].astype(int)))
        out = {}
        for feature, a in toxic.items():
            b = other.get(feature, 0)
            odds = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
            odds -= 2 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))  # two standard errors less
            if odds >= settings.evidence:
                out[feature] = odds
        return out

    words = weights(None)
    # A beginning is judged by the words that do not tell by themselves.
    return Evidence(words | weights(set(words)), prior)


def weight(word: str, evidence: Evidence) -> float:
    """Evidence of a word itself, or else of its strongest beginning; 0 without any."""
    weights = evidence.weights
    return weights.get(word) or max(
        weights.get(word[:4] + "*", 0.0) if len(word) > 4 else 0.0,
        weights.get(word[:5] + "*", 0.0) if len(word) > 5 else 0.0,
        weights.get(word[:6] + "*", 0.0) if len(word) > 6 else 0.0)


def score(words: Iterable[str], evidence: Evidence) -> float:
    """Probability from the prior and the evidence of the three strongest words."""
    best = [found for w in set(words) if (found := weight(w, evidence))]
    z = evidence.prior + sum(sorted(best)[-3:])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class Codes(dict):
    """Kind of raw tokens in a run, with a mark on those whose normal form tells something;
    of these ``word`` has the form. A token is read once, however often it stands in texts."""

    def __init__(self, read: Restorer, evidence: Evidence):
        self.read, self.evidence = read, evidence
        self.heads = {feature[:4] for feature in evidence.weights}
        self.told: dict[str, str] = {}

    def __missing__(self, raw: str) -> int:
        word, code = self.read._normal(raw), self.read.kinds._kind(raw)
        tells = word[:4] in self.heads and self.tells(word)
        if tells:
            code |= TELLS
        if len(raw) <= LATTICE_LENGTH:
            self[raw] = code
            if tells:
                self.told[raw] = word
        return code

    def tells(self, word: str) -> bool:
        return word in self.evidence.weights or weight(word, self.evidence) != 0

    def word(self, raw: str) -> str:
        found = self.told.get(raw)
        return self.read._normal(raw) if found is None else found

    def forget(self) -> None:
        if len(self) > KEPT_WORDS:
            self.clear()
            self.told.clear()


def telling_words(texts: list[str], codes: Codes) -> dict[int, set[str]]:
    """Per text, its restored words that tell something; no entry for a text without one.

    The tokens of all texts are numbered and looked up once each. Runs of short tokens are
    found in arrays; only those that may look spaced are read one by one.
    """
    codes.forget()
    raws = [t.split() for t in texts]
    bounds = np.cumsum([0, *map(len, raws)])
    numbered = pa.array(chain.from_iterable(raws), pa.string()).dictionary_encode()
    distinct = numbered.dictionary.to_pylist()
    number = numbered.indices.to_numpy()
    code = np.fromiter(map(codes.__getitem__, distinct), np.uint8, len(distinct))[number]
    kind, tells = code & 7, code >= TELLS
    found: dict[int, set[str]] = defaultdict(set)
    for first, last in _spaced_runs(kind, bounds):
        part = spaced(kind[first:last].tolist())
        if part:
            a, b = first + part[0], first + part[1]
            text = int(np.searchsorted(bounds, a, "right")) - 1
            tells[a:b] = False
            words = codes.read.run(raws[text][a - bounds[text] : b - bounds[text]])
            found[text].update(filter(codes.tells, words))
    at = np.flatnonzero(tells)
    for text, n in zip((np.searchsorted(bounds, at, "right") - 1).tolist(), number[at].tolist()):
        found[text].add(codes.word(distinct[n]))
    return found


def _spaced_runs(kind: np.ndarray, bounds: np.ndarray):
    """(first, last) of the runs of two and more short tokens of one text that have two
    odd ones side by side, or two letters among three letters and signs."""
    if not len(kind):
        return []
    short = kind > 0
    cut = np.zeros(len(kind) + 1, bool)
    cut[bounds] = True
    first = np.flatnonzero(short & np.r_[True, ~short[:-1] | cut[1:-1]])
    last = np.flatnonzero(short & np.r_[~short[1:] | cut[1:-1], True]) + 1

    def among(chosen):
        before = np.r_[0, np.cumsum(chosen)]
        return before[last] - before[first]

    beside = np.zeros(len(kind), bool)
    beside[1:] = (kind[1:] > 1) & (kind[:-1] > 1) & ((kind[1:] == ODD) | (kind[:-1] == ODD)) & ~cut[1:-1]
    maybe = (among(beside) > 0) | ((among(kind == LETTER) > 1) & (among((kind == SIGN) | (kind == LETTER)) > 2))
    maybe &= last - first > 1
    return list(zip(first[maybe].tolist(), last[maybe].tolist()))


def score_documents(docs: DataFrame, model: CharModel, evidence: Evidence,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score, n_restored, restored), a row per input row.

    ``restored`` lists the distinct words that differ from what is written, sorted.
    Null and empty texts have the score of the prior. Repeated rows and null ids are kept;
    other columns are not read; texts of any length are scored whole.
    """
    def run(batches):
        codes = Codes(Restorer(model), evidence)
        without = score([], evidence)
        for batch in common.slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in chunks(texts):
                scores, restored = [without] * (last - first), [[]] * (last - first)
                for i, words in telling_words(texts[first:last], codes).items():
                    low = texts[first + i].lower()
                    scores[i] = score(words, evidence)
                    restored[i] = sorted(w for w in words if w in evidence.weights and w not in low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(scores, pa.float64()),
                     pa.array(restored, pa.list_(pa.string()))], ["doc_id", "score", "restored"])

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(run, "doc_id long, score double, restored array<string>")
