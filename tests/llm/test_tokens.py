"""Encoding, decoding and counts against the tokenizer libraries."""

from __future__ import annotations

import hashlib
import random
import sys
from collections import Counter
from itertools import chain

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm import bpe_codec, fertility, token_counts
from tests.llm.helpers import AWKWARD, frame

CLIP = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "", "  ", "a", "Hello, World! it's <|endoftext|> é ÀΣ  \n x", "<|startoftext|>x<|endoftext|>",
    "ΟΔΥΣΣΕΥΣ İstanbul ﬁ \x1c y\x85z", "日本語テキスト 한국어 עברית 🎉🏳️‍🌈 1234 ½²", "x" * 3000,
    "ab" * 2000 + "c d", "    lots   of    space\t\t\r\n\n  end   ", "▁▁ a▁b", "don't we're I'LL 'S",
    "café é ẛ̣ ՘ Ᲊ", "\x00a\x01", "</s><s><unk> <0x0A>", "$$$###***&&&%%%" * 9,
    "aaaa aaaaaaa bananananana", *(r[1] or "" for r in AWKWARD),
]


def texts(seed: int, n: int = 150):
    draw = random.Random(seed)
    letters = [lambda: draw.randrange(32, 127), lambda: draw.randrange(0x80, 0x600),
               lambda: draw.randrange(0x600, 0xD7FF), lambda: draw.randrange(0x1F300, 0x1F700)]
    wild = ["".join(chr(draw.choice(letters)()) if draw.random() < 0.7 else draw.choice(" \n\t'")
                    for _ in range(60)) for _ in range(n)]
    return wild + ["".join(draw.choice("abcdeinorst aeiou thing'") for _ in range(300)) for _ in range(n)]


def test_ids_and_text_equal_the_library():
    library, own = Tokenizer.from_file(CLIP), bpe_codec.Codec(CLIP)
    samples = TEXTS + texts(1)
    ids = [e.ids for e in library.encode_batch(samples, add_special_tokens=False)]
    assert own.encode(samples) == [list(i) for i in ids]
    assert [own.decode(np.array(i, np.int64)) for i in ids] == [
        library.decode(i, skip_special_tokens=False) for i in ids]


def test_compatible_pairs_are_those_that_encode_to_themselves():
    own = bpe_codec.Codec(CLIP)
    draw = np.random.default_rng(2)
    left, right = draw.integers(512, 49406, 400), draw.integers(512, 49406, 400)
    inner = np.array([not own.text_of[t].endswith(own.end) for t in left])
    left, right = left[inner], right[inner]
    left, right = left[own._reachable(left) & own._reachable(right)], right[
        own._reachable(left) & own._reachable(right)]
    for a, b, fits in zip(left, right, own.compatible(left, right)):
        body = own.text_of[a] + own.text_of[b].removesuffix(own.end)
        symbols = list(body)
        if own.text_of[b].endswith(own.end):
            symbols[-1] += own.end
        assert fits == (own.merge(symbols) == [own.text_of[a], own.text_of[b]])


def test_words_are_proposed_together_as_one_by_one():
    own = bpe_codec.Codec(CLIP)
    words = sorted({w for t in TEXTS + texts(13) for w in own.pieces(t) if len(w.encode()) < 400})
    flat, owner, unfit = own.propose_all([w.encode() for w in words])
    one = [own.propose(own._mapped(w) + own.end) for w in words]
    assert unfit.tolist() == [p is None for p in one]
    assert [flat[owner == i].tolist() for i in range(len(words))] == [p or [] for p in one]
    assert [len(x) for x in own.propose_all([])] == [0, 0, 0]


def test_no_token_fits_a_place():
    own = bpe_codec.Codec(CLIP)
    for text in ("z", "q" + own.end):  # a vocabulary without these letters
        own.vocab = {t: i for t, i in own.vocab.items() if not t.startswith(text[0])}
    own._plant()
    words = ["hello", "xzx", "z", "helloq", "river"]
    flat, owner, unfit = own.propose_all([w.encode() for w in words])
    assert unfit.tolist() == [False, True, True, True, False]
    assert sorted(set(owner.tolist())) == [0, 4] and own.text_of[flat[owner == 4]].tolist() == ["river</w>"]


def test_stretches_are_encoded_as_the_library_does():
    library, own = Tokenizer.from_file(CLIP), bpe_codec.Codec(CLIP)
    draw = random.Random(14)
    parts = ["don't", "ΟΔΥΣ", "Σ", "ΑΣ.", "e", "\u0301", "a\u0301", "\x85", "\xa0", "\u3000", "\x1c", "\x00", "İ", "<|",
             "<|endoftext|>", "<|endoftext|>x", "|>", "\u1c8a", "\U0001fadf", "가", "\u1100\u1161", "x" * 70, "½", "日本"]
    samples = ["".join(draw.choice(parts) + draw.choice(("", "", " ", "\n", "\t", "\r\n", "\x0b", "  "))
                       for _ in range(draw.randrange(0, 12))) for _ in range(600)]
    want = [e.ids for e in library.encode_batch(samples, add_special_tokens=False)]
    for size in (1, 7, 600):
        got = [ids for i in range(0, 600, size) for ids in own.encode(samples[i : i + size])]
        assert got == want
    assert own.encode([]) == [] and own.encode(["", " "]) == [[], []]


def test_a_stretch_is_encoded_and_looked_up_once():
    own = bpe_codec.Codec(CLIP)
    samples, calls = ["some words, that stand here often. " * 100] * 40, 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids, bounds = own.encode_flat(samples)
    finally:
        sys.setprofile(None)
    assert bounds.tolist() == [800 * i for i in range(41)] and len(ids) == 32_000
    assert calls < 24_000 / 4


def test_encoded_documents(spark):
    library = Tokenizer.from_file(CLIP)
    got = bpe_codec.digests(bpe_codec.encode_documents(
        frame(spark, AWKWARD).selectExpr("*", "1 AS ids", "2 AS decoded"))).collect()
    want = []
    for row in AWKWARD:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        want.append((row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe_codec.encode_documents(frame(spark, [])).collect() == []


def test_counts_equal_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.Counter(PIECES)
    samples = TEXTS + texts(3)
    assert own.count_texts(samples) == [len(i) for i in library.encode(samples, num_threads=1)]


def test_counted_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = token_counts.token_counts(frame(spark, AWKWARD).selectExpr("*", "1 AS n_bytes"), limit=100).collect()
    want = []
    for row in AWKWARD:
        n = len(library.encode(row[1] or ""))
        want.append((row[0], len((row[1] or "").encode()), n, n > 100))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(frame(spark, [])).collect() == []


def base(text: str | None) -> tuple:
    """The base counts, written out plainly."""
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(repeated))


def test_base_rules(spark):
    draw = random.Random(9)
    rows = AWKWARD + [
        (100 + i, " ".join(draw.choices(["a", "b", "c#", "d|", "e\n", "\n\n", "f\xa0g", "é"], k=60)), "en", "s", 1)
        for i in range(20)]
    got = fertility.judge(frame(spark, rows).selectExpr("*", "0 AS entropy", "0 AS kept")).collect()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((tuple(r[c] for c in ("doc_id", *counts)) for r in got), key=str) == sorted(
        ((r[0], *base(r[1])) for r in rows), key=str)
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_bands_reject_what_breaks_into_bytes_and_keep_the_rest(spark):
    draw = random.Random(4)
    words = "the house stands near a river and people walk along its green banks every day".split()
    rows = [(i, " ".join(draw.choices(words, k=120)), "en", "s", 1) for i in range(60)]
    rows += [(900, " ".join("".join(chr(draw.randrange(0x12000, 0x12300)) for _ in range(4))
                            for _ in range(80)), "en", "s", 1)]
    got = {r["doc_id"]: r for r in fertility.judge(frame(spark, rows)).collect()}
    assert not got[900]["kept"] and "fallback" in got[900]["rejected_by"]
    assert sum(got[i]["kept"] for i in range(60)) >= 58


def measured_plainly(own, text):
    """The columns of a text, each word tokenised by itself."""
    words = text.encode().split()
    ids = list(chain.from_iterable(own.pieces.encode(w.decode()) for w in words))
    n_bytes = sum(len(own.bytes.encode_ordinary(" " + w.decode())) for w in words)
    n, chars, symbols, lines, repeated = base(text)
    scripts = Counter(s for s in fertility._scripts()[[ord(c) for c in text]].tolist() if s) if text else {}
    most = max(scripts.values(), default=0)
    return [n, chars, symbols, lines, repeated, len(ids), n_bytes,
            chars / len(ids) if ids else None, chars / n_bytes if n_bytes else None,
            sum(map(own.pieces.is_byte, ids)) / len(ids) if ids else None,
            fertility._entropy(np.array(ids)) if ids else None,
            min((s for s, k in scripts.items() if k == most), default=0)]


#: Two words with the same sum of letters times powers of any odd number modulo 2**64.
TWINS = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(2048)) for k in range(2)]


def test_measures_equal_words_measured_one_by_one():
    own = fertility.vocabularies(*fertility.default_vocabularies())
    draw = random.Random(11)
    spaced = ["f\xa0g", "\x85", "a\u3000", "\u2028b", "\x1cz", "\xa0", "it's", "#1|", "x", "тест", "日本語", "12½"]
    samples = TEXTS + texts(12, 40) + ["\n".join(" ".join(draw.choices(spaced, k=6)) for _ in range(9))
                                       for _ in range(60)]
    samples += ["a b c", "a b c d", " ".join([*"xyzxyz"]), "", "q r s", "q r s"]
    want = [measured_plainly(own, t) for t in samples]
    for first, last in bpe_codec.chunks(samples, 20_000):
        assert list(map(list, zip(*fertility._measure(own, samples[first:last])))) == want[first:last]


def test_repeated_words_are_told_apart_exactly():
    own = fertility.vocabularies(*fertility.default_vocabularies())
    text = f"{TWINS[0]} one two {TWINS[1]} one two"
    columns = fertility._measure(own, [text])
    assert columns[4] == [base(text)[4]] == [0]


def test_a_word_is_tokenised_and_looked_up_once():
    own = fertility.vocabularies(*fertility.default_vocabularies())
    fertility._scripts()
    samples, calls = ["some words that stand here often " * 100] * 40, 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        columns = fertility._measure(own, samples)
    finally:
        sys.setprofile(None)
    assert columns[0] == [600] * 40
    assert calls < sum(columns[0]) / 4


def test_no_rows(spark):
    assert fertility.judge(frame(spark, [])).collect() == []


@pytest.mark.parametrize("text, rest", [("", 1.0), ("a", 1.0)])
def test_entropy_of_nothing(text, rest):
    assert fertility._entropy(np.zeros(len(text), np.int64)) == rest


SYLLABLES = {
    "en": "the and ing tion er re on an ha at nd th ou ea is or ti en es of".split(),
    "fr": "les que ment des ion eau ou é è re an tre le ai oi en eux pa de ur".split(),
    "he": ["של", "את", "הוא", "לא", "על", "ים", "בית", "שלום", "ספר", "ארץ", "מלך", "יום"],
    "th": ["การ", "ความ", "ที่", "ไม่", "และ", "เป็น", "คน", "บ้าน", "น้ำ", "ใจ", "ดี", "มา"],
    "am": ["ሰላም", "ነው", "ቤት", "ልጅ", "ውሃ", "አገር", "ቀን", "ሰው", "መጽሐፍ", "ንጉሥ", "ምድር", "ፀሐይ"],
}


def prose(draw, lang, n):
    return ["".join(draw.choices(SYLLABLES[lang], k=draw.choice((1, 1, 2, 2, 3)))) for _ in range(n)]


def junk(draw, lang, n):
    return [w + draw.choice(("&&&", "%%%", "$$$", "***", "###")) for w in prose(draw, lang, n)]


def judged(spark, rows):
    docs = frame(spark, [(i, " ".join(words), lang, "s", 1) for i, (words, lang) in rows.items()])
    return {r["doc_id"]: r for r in fertility.judge(docs).collect()}


def test_bands_reject_symbols_between_words_of_any_length(spark):
    draw = random.Random(5)
    rows = {i: (prose(draw, "en", draw.randrange(60, 900)), "en") for i in range(240)}
    rows |= {1000 + i: (junk(draw, "en", draw.randrange(60, 900)), "en") for i in range(12)}
    got = judged(spark, rows)
    assert sum(not got[1000 + i]["kept"] for i in range(12)) >= 11
    assert any("entropy" in got[1000 + i]["rejected_by"] for i in range(12))
    assert sum(got[i]["kept"] for i in range(240)) >= 230


@pytest.mark.parametrize("size", [60, 199, 201])
def test_a_small_language_has_its_own_bands(spark, size):
    draw = random.Random(6)
    rows = {i: (prose(draw, "en", 150), "en") for i in range(300)}
    rows |= {1000 + i: (prose(draw, "fr", 150), "fr") for i in range(size - 4)}
    rows |= {2000 + i: (junk(draw, "fr", 150), "fr") for i in range(4)}
    got = judged(spark, rows)
    assert not any(got[2000 + i]["kept"] for i in range(4))
    assert sum(got[1000 + i]["kept"] for i in range(size - 4)) >= 0.95 * (size - 4)


@pytest.mark.parametrize("named", [True, False])
def test_few_documents_of_other_scripts_are_kept(spark, named):
    draw = random.Random(7)
    rows = {i: (prose(draw, "en", 150), "en") for i in range(300)}
    rows |= {1000 + 10 * k + i: (prose(draw, lang, 120), lang if named else None)
             for k, lang in enumerate(("he", "th", "am")) for i in range(1 + 2 * k)}
    got = judged(spark, rows)
    assert all(got[i]["kept"] for i in got if i >= 1000)
