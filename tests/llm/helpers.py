"""Small tables with every awkward case, and brute-force answers."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null, empty and blank texts, null ids and columns, repeated rows, one very long word.
AWKWARD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4),
    (4, "one", "en", None, 3), (5, "one", "en", "a", 3), (6, "x" * 50_000, None, None, 50_000),
    (7, "12345 !!! ---", "en", "b", 13), (7, "12345 !!! ---", "en", "b", 13),
    (None, "a text without an id that is long enough to have shingles", "en", "a", 10),
    (8, "日本語 тест ελληνικά 🎉 <|endoftext|> it's", "xx", "b", 20),
    (9, "word " * 5000, "en", "b", 25_000),
]


def prose(draw: random.Random, n: int, words: str = "alpha beta gamma delta epsilon zeta") -> str:
    syllables = words.split()
    return " ".join("".join(draw.choices(syllables, k=draw.randrange(1, 3))) for _ in range(n))


def frame(spark, rows, schema=DOCUMENTS):
    return spark.createDataFrame(rows, schema)


def classes(pairs, nodes) -> dict:
    """Smallest node that pairs reach, per node."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low
