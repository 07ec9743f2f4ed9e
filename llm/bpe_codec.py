"""BPE encoding and decoding by speculation and verification (operator 4).

A word's tokens are proposed by greedy longest match. A proposal is the exact encoding
if, and only if, every adjacent pair of tokens is compatible: the text of the pair alone
encodes to the pair. All pairs of a batch are tested at once, by walking back through the
merges that made their tokens. Only words with a failing pair are merged exactly. Vocabulary files are read from a path, never copied.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from llm.ragged_merge import NO_MERGE, merge_all

#: Words whose encoding a worker keeps, and the longest word that is kept.
KEPT_WORDS, KEPT_LENGTH = 250_000, 64
#: Sign of the end of a word in the tree of tokens, and the number of signs.
END_SIGN, SIGNS = 256, 257
#: Stands for the end of a stretch among tokens.
_MARK = np.uint32(0xFFFFFFFF)
#: Characters of text handled at once in a task; a longer text is handled alone.
CHUNK_CHARS = 1_000_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable, else from 256 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=1)
def _unassigned() -> np.ndarray:
    """Of each code point, whether Python's Unicode tables do not know it."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


class Codec:
    """Vocabulary, merges and word caches of one tokenizer file.

    The file holds BPE with a word-end suffix over byte letters, a split pattern, NFC and
    lower case, and added tokens that are found in raw text.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {**self.vocab, **self.added}
        self.size = max(ids.values()) + 1
        self.text_of = np.full(self.size, "", dtype=object)
        for text, i in ids.items():
            self.text_of[i] = text
        self.longest = max(map(len, self.vocab))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space is only ever a separator, so it need not be collapsed first. The
        # class is Unicode's White_Space, which Python's \s exceeds.
        pattern = split["pattern"]["Regex"].replace(
            r"\s", r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000")
        self.words = regex.compile(pattern)
        self.words_and_ends = regex.compile(rf"\n|{pattern}")
        self.cut = regex.compile("(%s)" % "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        self.letters = _byte_letters()
        self.library = None
        self.path = path
        # Tokens, four bytes each, of words, and of stretches without ASCII white space.
        self.cache: dict[str, bytes] = {}
        self.stretches: dict[bytes, bytes] = {}
        # Of each token: the rank of the merge that makes it (-1 for a letter) and its parts.
        self.born = np.full(self.size, -1, np.int64)
        self.left_part = np.arange(self.size)
        self.right_part = np.arange(self.size)
        rows = []
        for i, (a, b) in enumerate(merges):
            if a in self.vocab and b in self.vocab and a + b in self.vocab:
                a, b, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
                rows.append((a * self.size + b, i, made))
                if self.born[made] < 0:
                    self.born[made], self.left_part[made], self.right_part[made] = i, a, b
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.merge_keys, self.merge_ranks, self.merge_made = table.T.copy()
        # Token of each byte inside a word and at its end, if the vocabulary has them all.
        both = [[self.vocab.get(c + e) for c in self.letters] for e in ("", self.end)]
        self.letter_ids = None if None in both[0] + both[1] else np.array(both, np.int64)
        self.known = np.full(self.size, -1, np.int8)
        self.byte_map = {i: c for i, c in enumerate(self.letters)}
        self._plant()

    def _plant(self) -> None:
        """A tree of the tokens by bytes, END_SIGN after those that end a word: steps from
        node * SIGNS + sign, in order, the node of each, and the token of a node or -1."""
        byte_of = {c: b for b, c in enumerate(self.letters)}
        steps: dict[int, int] = {}
        tokens = {}
        for text, i in self.vocab.items():
            body = text.removesuffix(self.end)
            if not body or not all(c in byte_of for c in body):
                continue
            node = 0
            for sign in [*map(byte_of.__getitem__, body), *[END_SIGN] * (body != text)]:
                node = steps.setdefault(node * SIGNS + sign, len(steps) + 1)
            tokens[node] = i
        self.steps = np.array(sorted(steps), np.int64)
        self.step_to = np.fromiter(map(steps.__getitem__, self.steps.tolist()), np.int64, len(steps))
        self.token_at = np.full(len(steps) + 1, -1, np.int64)
        self.token_at[list(tokens)] = list(tokens.values())

    # --- words of a text

    def pieces(self, text: str) -> list[str]:
        """Words in order; added tokens appear as themselves behind a NUL mark."""
        if "<|" not in text:
            return self._words(text)
        out = []
        for i, part in enumerate(self.cut.split(text)):
            out += ["\0" + part] if i % 2 else self._words(part)
        return out

    def _words(self, text: str, pattern=None) -> list[str]:
        if not text.isascii():
            if _unassigned()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any():
                return self._library_words(text)
            # Each character is lowered alone: no final form of sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return (pattern or self.words).findall(text.lower())

    def _library_words(self, text: str) -> list[str]:
        """Words of a text with characters younger than Python's Unicode tables: the
        library's own tables decide on them."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        byte_of = {c: b for b, c in enumerate(self.letters)}
        split = self.library.pre_tokenizer.pre_tokenize_str(
            self.library.normalizer.normalize_str(text))
        return [bytes(byte_of[c] for c in word).decode() for word, _ in split]

    # --- exact merging

    def _mapped(self, word: str) -> str:
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.byte_map)

    def symbols(self, word: str) -> list[str]:
        out = list(self._mapped(word))
        out[-1] += self.end
        return out

    def merge(self, symbols: list[str]) -> list[str]:
        """Exact BPE: the lowest-ranked pair first, leftmost among equals."""
        if len(symbols) > KEPT_LENGTH:
            return self._merge_long(symbols)
        symbols = list(symbols)
        rank = self.rank
        while len(symbols) > 1:
            best, at = min((rank.get(p, 1 << 60), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            if best == 1 << 60:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        part: list[str | None] = list(symbols)
        after = [*range(1, len(part)), -1]
        before = [*range(-1, len(part) - 1)]
        queue = [(self.rank[p], i, p) for i, p in enumerate(zip(part, part[1:])) if p in self.rank]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i] if part[i] is not None else -1
            if j < 0 or (part[i], part[j]) != pair:
                continue
            part[i], part[j] = part[i] + part[j], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if a >= 0 and b >= 0 and (part[a], part[b]) in self.rank:
                    heapq.heappush(queue, (self.rank[part[a], part[b]], a, (part[a], part[b])))
        return [p for p in part if p is not None]

    # --- speculation

    def propose(self, text: str) -> list[int] | None:
        """Greedy longest match; None where no token fits."""
        vocab, longest = self.vocab, self.longest
        tail, at, out = len(text) - len(self.end), 0, []
        while at < tail:
            if tail - at <= longest and (i := vocab.get(text[at:])) is not None:
                out.append(i)
                return out
            for to in range(min(tail - 1, at + longest), at, -1):
                if (i := vocab.get(text[at:to])) is not None:
                    break
            else:
                return None
            out.append(i)
            at = to
        return None

    def propose_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match of words together, a byte of each a round: the tokens, the
        number of the word of each, and whether a word has a place where no token fits."""
        size = np.array([len(w) for w in words], np.int64)
        signs = np.frombuffer(common.END.join([*words, common.END]), np.uint8).astype(np.int64)
        stop = np.cumsum(size + 1) - 1
        signs[stop] = END_SIGN
        unfit = np.zeros(len(words), bool)
        word, at, stop = np.arange(len(words)), stop - size, stop
        node, token, after = np.zeros(len(words), np.int64), np.full(len(words), -1), at.copy()
        found, owner = [], []
        while len(word):
            wanted = node * SIGNS + signs[at]
            step = np.minimum(np.searchsorted(self.steps, wanted), len(self.steps) - 1)
            goes = self.steps[step] == wanted
            node = np.where(goes, self.step_to[step], 0)
            at = at + goes
            # A token inside a word leaves a letter for the one that ends it.
            fits = (self.token_at[node] >= 0) & goes & (at != stop)
            token, after = np.where(fits, self.token_at[node], token), np.where(fits, at, after)
            ended = np.flatnonzero(~goes)
            if not len(ended):
                continue
            unfit[word[ended[token[ended] < 0]]] = True
            found.append(token[ended])
            owner.append(word[ended])
            at[ended] = after[ended]
            goes[ended] = (token[ended] >= 0) & (after[ended] <= stop[ended])
            token[ended] = -1
            if not goes.all():
                word, at, stop, node, token, after = (x[goes] for x in (word, at, stop, node, token, after))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), unfit
        found, owner = np.concatenate(found), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        order = order[~unfit[owner[order]]]
        return found[order], owner[order], unfit

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens encodes to itself.

        While the left token is being merged, the symbol at its right edge changes at the
        ranks of its merges, and so does the left edge of the right token. The pair fails
        if two edge symbols that exist at the same time have a merge that comes first.
        All pairs walk back through their merges together.
        """
        fits = np.ones(len(left), bool)
        x, y = left.copy(), right.copy()
        x_ends = np.full(len(x), 1 << 40, np.int64)
        y_ends = x_ends.copy()
        live = np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            at = np.minimum(np.searchsorted(self.merge_keys, a * self.size + b), len(self.merge_keys) - 1)
            rank = np.where(self.merge_keys[at] == a * self.size + b, self.merge_ranks[at], 1 << 41)
            # Of two equal merges the one further left comes first.
            crossed = (rank < x_ends[live]) & (rank <= y_ends[live])
            fits[live[crossed]] = False
            born_a, born_b = self.born[a], self.born[b]
            live = live[~crossed & ((born_a >= 0) | (born_b >= 0))]
            a, b = x[live], y[live]
            from_left = self.born[a] > self.born[b]
            i, j = live[from_left], live[~from_left]
            x_ends[i], x[i] = self.born[x[i]], self.right_part[x[i]]
            y_ends[j], y[j] = self.born[y[j]], self.left_part[y[j]]
        return fits

    def _reachable(self, tokens: np.ndarray) -> np.ndarray:
        """Whether merging a token's own letters gives the token; decided once each."""
        for t in tokens[self.known[tokens] < 0]:
            body = self.text_of[t]
            symbols = list(body.removesuffix(self.end))
            if body.endswith(self.end) and symbols:
                symbols[-1] += self.end
            self.known[t] = self.merge(symbols) == [body]
        return self.known[tokens] > 0

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The tokens of each word, four bytes each."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        short = [i for i, w in enumerate(raw) if len(w) <= KEPT_LENGTH]
        flat, owner, unfit = self.propose_all([raw[i] for i in short])
        bad = np.zeros(len(words), bool)
        short = np.array(short, np.int64)
        owner, bad[short] = short[owner], unfit
        if len(short) < len(words):
            # Long words are proposed one by one: their rounds would be many and small.
            rest = np.setdiff1d(np.arange(len(words)), short).tolist()
            proposed = [self.propose(self._mapped(words[i]) + self.end) for i in rest]
            sizes = [len(p or ()) for p in proposed]
            bad[[i for i, n in zip(rest, sizes) if not n]] = True
            flat = np.r_[flat, np.fromiter(chain.from_iterable(p or () for p in proposed), np.int64, sum(sizes))]
            owner = np.r_[owner, np.repeat(np.array(rest, np.int64), sizes)]
            order = np.argsort(owner, kind="stable")
            flat, owner = flat[order], owner[order]
        tokens, back = np.unique(flat, return_inverse=True)
        bad[owner[~self._reachable(tokens)[back]]] = True
        if len(flat) > 1:
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            bad[owner[inside[~self.compatible(flat[inside], flat[inside + 1])]]] = True
        held, cut = flat.astype(np.uint32).tobytes(), 4 * np.searchsorted(owner, np.arange(len(words) + 1))
        out = [held[a:b] for a, b in pairwise(cut.tolist())]
        failed = np.flatnonzero(bad).tolist()
        for i, merged in zip(failed, self.merge_words([words[i] for i in failed])):
            out[i] = np.array(merged, np.uint32).tobytes()
        return out

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.merge_keys, wanted), len(self.merge_keys) - 1)
        hit = self.merge_keys[at] == wanted
        return np.where(hit, self.merge_ranks[at], NO_MERGE), self.merge_made[at]

    def merge_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Exact tokens: short words merge in rounds, long ones one by one."""
        out: list[tuple[int, ...]] = [()] * len(words)
        short = []
        for i, word in enumerate(words):
            if len(word) > KEPT_LENGTH or self.letter_ids is None:
                out[i] = tuple(self.vocab[t] for t in self.merge(self.symbols(word)) if t in self.vocab)
            else:
                short.append(i)
        if short:
            raw = [words[i].encode("utf-8", "surrogatepass") for i in short]
            size = np.array([len(r) for r in raw], np.int64)
            letters = np.frombuffer(b"".join(raw), np.uint8)
            sym = self.letter_ids[0][letters]
            ends = np.cumsum(size) - 1
            sym[ends] = self.letter_ids[1][letters[ends]]
            sym, own = merge_all(sym, np.repeat(np.arange(len(short)), size), self._ranked)
            cut = np.searchsorted(own, np.arange(len(short) + 1)).tolist()
            tokens = sym.tolist()
            for row, i in enumerate(short):
                out[i] = tuple(tokens[cut[row] : cut[row + 1]])
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, bounds = self.encode_flat(texts)
        return [ids[a:b].tolist() for a, b in pairwise(bounds.tolist())]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts one after another, and the bounds of those of each.

        White space always separates words, and neither composition nor lower case reaches
        across it, so each different stretch without ASCII white space is encoded once.
        """
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw = np.frombuffer(b"".join(data), np.uint8)
        bounds = np.cumsum([0, *map(len, data)])
        starts, ends = common.word_spans(raw, bounds)
        number, distinct = common.distinct_words(raw, starts, ends)
        ids, after = common.expand(self._stretches(distinct), number)
        return ids, after[np.searchsorted(starts, bounds)]

    def _stretches(self, distinct: list[bytes]) -> list[bytes]:
        if len(self.stretches) > KEPT_WORDS:
            self.stretches.clear()
        missing = [w for w in distinct if w not in self.stretches]
        pieces = self._pieces_and_ends([w.decode("utf-8", "surrogatepass") for w in missing])
        held = b"".join(map(self._tokens(set(pieces)).__getitem__, pieces))
        ends = 4 * np.flatnonzero(np.frombuffer(held, np.uint32) == _MARK)
        self.stretches.update(
            (w, held[a:b]) for w, a, b in zip(missing, [0, *(ends + 4).tolist()], ends.tolist()))
        out = [self.stretches[w] for w in distinct]
        for w in missing:
            if len(w) > KEPT_LENGTH:
                del self.stretches[w]
        return out

    def _pieces_and_ends(self, stretches: list[str]) -> list[str]:
        """Words of all stretches, and a line end after each stretch."""
        joined = "\n".join([*stretches, ""])
        if "<|" in joined or not joined.isascii() and _unassigned()[
                np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].any():
            return list(chain.from_iterable([*self.pieces(s), "\n"] for s in stretches))
        return self._words(joined, self.words_and_ends)

    def _tokens(self, words: set[str]) -> dict[str, bytes]:
        """Tokens of these words; of a line end, the mark."""
        if len(self.cache) > KEPT_WORDS:
            self.cache.clear()
        found = {w: self.cache[w] for w in words if w in self.cache}
        missing = [w for w in words if w not in found and w != "\n"]
        marked = [w for w in missing if w[0] == "\0" and w[1:] in self.added]
        found.update((w, np.uint32(self.added[w[1:]]).tobytes()) for w in marked)
        missing = [w for w in missing if w not in found]
        found.update(zip(missing, self.encode_words(missing)))
        self.cache.update((w, found[w]) for w in missing if len(w) <= KEPT_LENGTH)
        found["\n"] = _MARK.tobytes()
        return found

    def decode(self, ids) -> str:
        """Tokens joined by a space: the file names no decoder."""
        return " ".join(self.text_of[ids]) if len(ids) else ""


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def chunks(texts: list[str], most: int = CHUNK_CHARS):
    """Bounds of runs of texts of about ``most`` characters."""
    first = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, ids array<int>, decoded), a row per input row.

    ``decoded`` is decoded from ``ids``. A null or empty text has no ids and decodes to an
    empty text; null ids and repeated rows are kept; other columns are not read; words and
    texts of any length are encoded whole.
    """
    path = vocabulary or default_vocabulary()

    def run(batches):
        own = codec(path)
        for batch in common.slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in chunks(texts):
                ids, bounds = own.encode_flat(texts[first:last])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                     pa.array([own.decode(ids[a:b]) for a, b in pairwise(bounds.tolist())], pa.string())],
                    ["doc_id", "ids", "decoded"])

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return encoded.select(
        "doc_id", *carry, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
