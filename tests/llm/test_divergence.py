"""The audit of sources against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from llm import divergence
from llm.divergence import Audit, Tree
from tests.llm.helpers import AWKWARD, DOCUMENTS, frame


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def expected(rows, settings=Audit()):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= settings.least_docs]

        def shares(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + settings.unit * (count[t] + 1) // (size + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))

        def gap(a, b, t):
            return (a[t] - b[t]) ** 2 // b[t]

        for s in sources:
            pairs = [("pair", o, sum(gap(p[s], p[o], t) for t in kept)) for o in sources - {s}]
            found = [("term", t, gap(p[s], whole, t)) for t in kept
                     if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, top in ((pairs, None), (found, settings.top)):
                part.sort(key=lambda r: (-r[2], r[1].encode()))
                out += [(lang, s, *r, k) for k, r in enumerate(part[:top], 1)]
    return sorted(out)


def corpus(seed=5, n=300, sources=7):
    draw = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)] + ["été", "日本"]
    rows = []
    for i in range(n):
        k = min(int(draw.expovariate(0.8)), sources - 1)
        own = words[k * 5 :] + words[: 10]
        text = " ".join(draw.choices(own, k=draw.randrange(0, 25))) + draw.choice(["", " The the", "'x"])
        rows.append((i, text, draw.choice(["en", "fr", None]), f"s{k}" if k else None, 1))
    return rows


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("settings", [Audit(), Audit(least_docs=1, top=3), Audit(least_docs=20)])
def test_equals_brute_force(spark, settings):
    rows = corpus() + AWKWARD
    assert result(divergence.audit(frame(spark, rows).repartition(6), settings)) == expected(rows, settings)


def test_small_batches_of_paths(spark):
    """Paths that several trees hold give the same sums."""
    rows = corpus(seed=8)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert result(divergence.audit(frame(spark, rows))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_groups_without_terms(spark):
    rows = [(1, "same same", "en", "a", 1), (2, "same", "en", "b", 1), (3, None, "en", "c", 0),
            (4, "12 34", "en", "d", 0), (5, "once", "de", "a", 0), (6, None, "de", "b", 0),
            (7, "same", "en", "a", 0), (8, None, None, None, 0)]
    found = result(divergence.audit(frame(spark, rows)))
    assert found == expected(rows)
    assert [r for r in found if r[0] == "de"] == [
        ("de", "a", "pair", "b", 0, 1), ("de", "b", "pair", "a", 0, 1)]


def test_empty_and_clashing(spark):
    assert result(divergence.audit(frame(spark, []))) == []
    rows = corpus(n=60)
    docs = spark.createDataFrame(
        [(t, lang, s, "x", 1, 2) for _, t, lang, s, _ in rows],
        "text string, lang string, source string, term string, n long, p int")
    assert result(divergence.audit(docs, Audit(least_docs=1))) == expected(rows, Audit(least_docs=1))


def test_tree_shares_paths_and_is_exact():
    draw = random.Random(2)
    paths = []
    for _ in range(200):
        held = sorted(draw.sample(range(9), draw.randrange(2, 7)))
        paths.append(([(f"s{k}", draw.choice([1, 10**9 + 1, 5 * 10**8]), 1 + k) for k in held],
                      draw.choice([1, 7, 1 << 33])))
    for scale in (1, 1 << 40):
        tree = Tree()
        for path, times in paths:
            tree.insert("en", path, times * scale)
        assert len(tree.parent) < sum(len(p) for p, _ in paths)
        sums = Counter()
        for path, times in paths:
            for a in path:
                for b in path:
                    if a != b:
                        def gap(p, q):
                            return (p - q) ** 2 // q
                        sums[a[0], b[0]] += scale * times * (
                            gap(a[1], b[1]) - gap(a[1], b[2]) - gap(a[2], b[1]) + gap(a[2], b[2]))
        found = {(s, o): high * (1 << divergence.LIMB) + low
                 for _, s, o, high, low in tree.corrections()}
        assert found == {k: v for k, v in sums.items()}


def test_sql():
    rows = corpus(n=120) + AWKWARD
    names = [f.split()[0] for f in DOCUMENTS.split(", ")]
    with duckdb.connect() as db:
        db.register("documents", pa.Table.from_pylist([dict(zip(names, r)) for r in rows]))
        assert sorted(db.sql(divergence.oracle_sql()).fetchall()) == expected(rows)
