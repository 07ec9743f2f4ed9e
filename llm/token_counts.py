"""Token counts by rank-synchronous merging of ragged arrays (operator 9).

Texts are cut into pre-tokens where no piece of the vocabulary can reach across. The
pre-tokens of a batch that are not known yet lie in one flat array of symbols. In each
round every pre-token merges its best-ranked pair, leftmost among equals, all at once;
pre-tokens without a pair are done and what is left of their symbols is counted.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import common
from llm.bpe_codec import chunks
from llm.ragged_merge import NO_MERGE, merge_all

#: Pre-tokens whose count a worker keeps; longer ones are merged by a queue, not in rounds.
KEPT_TOKENS, ROUND_LENGTH = 400_000, 200
_SPACE = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Counter:
    """Merges of a sentencepiece BPE model with byte fallback and a leading space mark.

    A symbol is a piece or a character. A character that is no piece counts its bytes.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores = {
            model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        }
        letters = sorted(set("".join(scores)))
        symbols = [*scores, *(c for c in letters if c not in scores)]
        number = {s: i for i, s in enumerate(symbols)}
        self.unknown = len(symbols)
        self.size = self.unknown + 5
        self.weight = np.array([1 if s in scores else len(s.encode()) for s in symbols]
                               + [0, 1, 2, 3, 4], np.int64)
        # Characters of no piece: one symbol per number of bytes, without merges.
        self.of_char = np.full(0x110000, self.unknown + 4, np.int64)
        self.of_char[:0x10000] = self.unknown + 3
        self.of_char[:0x800] = self.unknown + 2
        self.of_char[:0x80] = self.unknown + 1
        for c in letters:
            self.of_char[ord(c)] = number[c]
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        found = [
            (number[p[:k]] * self.size + number[p[k:]], order[score], number[p])
            for p, score in scores.items() for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        ]
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.results = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()
        if any(_SPACE in p.strip(_SPACE) or (_SPACE in p[1:] and p.strip(_SPACE)) for p in scores):
            raise ValueError("pieces with inner spaces are not supported")
        # A line feed that is in no piece separates too.
        bar = "\n" if "\n" not in letters else ""
        self.split = re.compile(f"{_SPACE}*[^{_SPACE}{bar}]+|{_SPACE}+" + (f"|{bar}" if bar else ""))
        self.cache: dict[str, int] = {}

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return np.where(hit, self.ranks[at], NO_MERGE), self.results[at]

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.of_char[points]

    def count(self, tokens: list[str]) -> np.ndarray:
        """Symbols left of each pre-token."""
        out = np.zeros(len(tokens), np.int64)
        short = [i for i, t in enumerate(tokens) if len(t) <= ROUND_LENGTH]
        if short:
            out[short] = self._rounds([tokens[i] for i in short])
        for i, t in enumerate(tokens):
            if len(t) > ROUND_LENGTH:
                out[i] = self._queue(t)
        return out

    def _rounds(self, tokens: list[str]) -> np.ndarray:
        own = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        sym, own = merge_all(self.symbols("".join(tokens)), own, self._ranked)
        return np.bincount(own, self.weight[sym], len(tokens)).astype(np.int64)

    def _queue(self, token: str) -> int:
        """The same merges for one long pre-token."""
        sym = self.symbols(token).tolist()
        n = len(sym)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        table = self.table
        queue = []
        for i in range(n - 1):
            if hit := table.get((sym[i], sym[i + 1])):
                queue.append((hit[0], i, sym[i], sym[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i] if sym[i] == a else -1
            if j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = table[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else -1
                if y >= 0 and (hit := table.get((sym[x], sym[y]))):
                    heapq.heappush(queue, (hit[0], x, sym[x], sym[y]))
        return int(sum(self.weight[s] for s in sym if s >= 0))

    @property
    def table(self) -> dict[tuple[int, int], tuple[int, int]]:
        if not hasattr(self, "_table"):
            left, right = np.divmod(self.keys, self.size)
            self._table = dict(zip(zip(left.tolist(), right.tolist()),
                                   zip(self.ranks.tolist(), self.results.tolist())))
        return self._table

    def count_texts(self, texts: list[str]) -> list[int]:
        split = [self.split.findall(_SPACE + t.replace(" ", _SPACE)) if t else [] for t in texts]
        if len(self.cache) > KEPT_TOKENS:
            self.cache.clear()
        cache = self.cache
        missing = list(set(chain.from_iterable(split)) - cache.keys())
        cache.update(zip(missing, self.count(missing).tolist()))
        out = [sum(map(cache.__getitem__, s)) for s in split]
        for t in missing:
            if len(t) > ROUND_LENGTH:
                del cache[t]
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(
    docs: DataFrame, model: str | None = None, limit: int = 4096,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row per input row.

    Null and empty texts have no bytes and no tokens. Null ids and repeated rows are kept;
    other columns are not read; texts and words of any length are counted whole.
    """
    path = model or default_model()

    def run(batches):
        own = counter(path)
        for batch in common.slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in chunks(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.array([len(t.encode()) for t in texts[first:last]], pa.int64()),
                     pa.array(own.count_texts(texts[first:last]), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
