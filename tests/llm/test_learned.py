"""Toxicity, lattice dedup, site quality and source mixing."""

from __future__ import annotations

import math
import random
import sys
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from llm import entry, lattice_dedup, site_quality, source_mix, toxicity
from tests.llm.helpers import AWKWARD, classes, frame

FOLDER = "/root/testdata/sf0.001"

# --- toxicity

CLEAN = "the river runs along green fields and people walk there every day in summer".split()


def toxic_rows(seed: int, n: int, first: int):
    """Texts, some with a bad word or one with a bad beginning, some of these disguised."""
    draw = random.Random(seed)
    hide = {"stupid": ["stup1d", "s.t.u.p.i.d", "stuuupid", "5tupid", "s t u p i d"],
            "moron": ["m0ron", "m-o-r-o-n", "moooron", "m o r o n"]}
    rows, labels, hidden = [], [], []
    for i in range(first, first + n):
        words = draw.choices(CLEAN, k=30)
        bad = i % 3 == 0
        if bad:
            word = draw.choice(["stupid", "moron", "vequ" + draw.choice("abcdefg") * 2])
            if draw.random() < 0.5 and word in hide:
                word = draw.choice(hide[word])
                hidden.append(i)
            words.insert(draw.randrange(30), word)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels, hidden


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels, _ = toxic_rows(1, 400, 0)
    docs = frame(spark, rows)
    model = toxicity.char_model(docs)
    marked = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    return model, toxicity.learn(docs, marked, model)


def test_held_out_texts(spark, learned):
    rows, labels, hidden = toxic_rows(2, 200, 10_000)
    got = {r["doc_id"]: r for r in toxicity.score_documents(frame(spark, rows), *learned).collect()}
    wrong = [i for i, _, bad in labels if (got[i]["score"] >= 0.5) != bool(bad)]
    assert len(wrong) <= 4, wrong
    found = [i for i in hidden if got[i]["restored"]]
    assert len(found) >= 0.9 * len(hidden)


def every_path(word, model):
    """The cheapest reading of a word among all, tried one by one."""
    best = {"": 0.0}
    for i in range(len(word)):
        after = defaultdict(lambda: math.inf)
        for text, cost in best.items():
            for out, channel in toxicity._choices(word, i):
                after[text + out] = min(after[text + out], cost + channel)
        best = after

    def total(text, cost):
        full = "\x01\x01" + text + "\x01"
        return cost + sum(model.cost(*full[i : i + 3]) for i in range(len(full) - 2))

    return min(total(t, c) for t, c in best.items()), {t: total(t, c) for t, c in best.items()}


def test_viterbi_finds_the_cheapest_reading(learned):
    for word in ("stup1d", "5tuuup!d", "m0r-0n", "h3llo", "aa", "x", "p30p1e", "riiiver"):
        best, value = every_path(word, learned[0])
        assert value[toxicity.restore(word, learned[0])] == pytest.approx(best)


def test_plain_words_stay(learned):
    read = toxicity.Restorer(learned[0])
    assert read("The river, runs (along) GREEN fields. 1998 2.0") == [
        "the", "river", "runs", "along", "green", "fields", "1998", "2.0"]


@pytest.fixture(scope="module")
def reader(spark):
    words = [*CLEAN, *"a stupid moron scum man was seen".split()]
    draw = random.Random(3)
    return toxicity.Restorer(toxicity.char_model(
        frame(spark, [(i, " ".join(draw.choices(words, k=40)), "en", "s", 1) for i in range(200)])))


@pytest.mark.parametrize("text, words", [
    ("s t u p i d.", ["stupid"]), ("s c u m!", ["scum"]), ("(s c u m)", ["scum"]), ("$ c u m", ["scum"]),
    ("$ t u p 1 d", ["stupid"]), ("a s t u p i d man", ["a", "stupid", "man"]),
    ("s t u p i d m o r o n", ["stupid", "moron"]), ("s  t\nu p  i\td", ["stupid"]), ("stu pid", ["stupid"]),
    ("the m a n was seen", ["the", "man", "was", "seen"]), ("stuupid", ["stupid"]), ("s_tu_pid", ["stupid"]),
    ("the man was in a field", ["the", "man", "was", "in", "a", "field"]), ("1 9 9 8", ["1", "9", "9", "8"]),
])
def test_white_space_is_read_by_the_lattice(reader, text, words):
    assert [w for w in reader(text) if w] == [w for w in words]


def test_doubled_letters_have_the_cheapest_reading(reader):
    for word in ("stuupid", "mmoron", "seenn", "fieelldd", "aa", "summer", "greenn", "ssccuumm"):
        best, value = every_path(word, reader.model)
        assert value[toxicity.restore(word, reader.model)] == pytest.approx(best)


@pytest.mark.parametrize("text, word", [
    ("m" + "0" * 50 + "ron", "moron"), ("-".join("sc").replace("-", "-" * 20) + "-" * 20 + "u" + "-" * 20 + "m", "scum"),
    ("s" + "t" * 60 + "up1d", "stupid")])
def test_long_words_are_lattices_too(reader, text, word):
    assert reader(text) == [word]


def test_long_runs_are_read_in_linear_time(reader):
    assert set(reader("s t u p i d " * 5000)) == {"stupid"}


def test_awkward_toxicity_rows(spark, learned):
    docs = frame(spark, AWKWARD).selectExpr("*", "1 AS score", "2 AS restored")
    got = toxicity.score_documents(docs, *learned).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    empty = toxicity.learn(frame(spark, []), spark.createDataFrame([], "doc_id long, toxic int"),
                           toxicity.char_model(frame(spark, [])))
    assert empty.weights == {}
    assert toxicity.score_documents(frame(spark, []), *learned).collect() == []


def plainly(text, read, evidence):
    """Score and restored words of a text whose words are read one by one."""
    words, low = read(text), text.lower()
    return (toxicity.score(words, evidence),
            sorted(w for w in set(words) if w in evidence.weights and w not in low))


def test_scores_equal_those_of_words_read_one_by_one(spark, learned):
    model, evidence = learned
    draw = random.Random(8)
    tokens = [*CLEAN, *"s t u p i d m 0 r n $ ! . - a I stu pid mo ron, (s u) st5 5tupid stuupid vequaa, "
              "vequzz MORON. Moron; sTupid!! ½ ² İİ ß é\u0301 日本 --- <a> x\x1cy s.t.u.p.i.d".split(" "), "m" * 60 + "0ron"]
    texts = ["".join(w + draw.choice((" ", " ", "\n", "\u2003", "  "))
                     for w in draw.choices(tokens, k=draw.randrange(0, 60))) for _ in range(400)]
    rows, _, _ = toxic_rows(9, 100, 0)
    texts += [*(r[1] for r in rows), *(r[1] or "" for r in AWKWARD), "s", "s t", "s t u", "a", ""]
    read = toxicity.Restorer(model)
    want = [plainly(t, read, evidence) for t in texts]
    assert sum(bool(w[1]) for w in want) > 50
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    got = sorted(toxicity.score_documents(docs, model, evidence).collect())
    assert [(r["score"], r["restored"]) for r in got] == want


def test_a_token_is_read_once_however_often_it_stands(learned):
    codes = toxicity.Codes(toxicity.Restorer(learned[0]), learned[1])
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    texts = [" ".join(CLEAN * 40)] * 50
    sys.setprofile(count)
    try:
        found = toxicity.telling_words([*texts, "a moron"], codes)
    finally:
        sys.setprofile(None)
    assert dict(found) == {50: {"moron"}}
    assert calls < sum(len(t.split()) for t in texts) / 4


# --- lattice

def test_nearest_point_is_nearest():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(200, 8)) * 2
    found = lattice_dedup.nearest_e8(x)
    sums, halves = found.sum(1), (found % 1 == 0.5)
    assert np.allclose(sums % 2, 0) and (halves.all(1) | ~halves.any(1)).all()
    short = lattice_dedup.minimal_vectors()
    assert short.shape == (240, 8) and np.allclose((short**2).sum(1), 2)
    # A point is nearest if none of its 240 neighbours is nearer.
    own = ((x - found) ** 2).sum(1)
    assert (((x[:, None] - found[:, None] - short) ** 2).sum(2) >= own[:, None] - 1e-9).all()


def pairs_at(draw, n, size, low):
    """Unit vectors in pairs with cosines from ``low`` up."""
    a = draw.normal(size=(n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = draw.normal(size=(n, size))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cos = draw.uniform(low, low + 0.01, (n, 1))
    return a, cos * a + np.sqrt(1 - cos**2) * b


def test_recall_at_the_threshold():
    draw = np.random.default_rng(2)
    a, b = pairs_at(draw, 2000, 64, 0.931)
    lattice = lattice_dedup.Lattice()
    x, y = lattice_dedup.cells(a, lattice), lattice_dedup.cells(b, lattice)
    met = (x[:, :, :, None] == y[:, :, None, :]).any((1, 2, 3))
    assert met.mean() >= 0.9


def test_codes_do_not_depend_on_the_batch():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(300, 61))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lattice = lattice_dedup.Lattice()
    whole = lattice_dedup.cells(x, lattice)
    for step in (1, 2, 7, 128):
        parts = [lattice_dedup.cells(x[i : i + step], lattice) for i in range(0, len(x), step)]
        assert (np.concatenate(parts) == whole).all()


def test_links_of_a_block_count_in_its_own_task_only():
    draw = np.random.default_rng(6)
    x = draw.normal(size=24) + draw.normal(size=(5, 24)) * 0.05
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    lattice, rows = lattice_dedup.Lattice(), np.arange(5)
    own = lattice_dedup._links(unit, rows, np.full(5, 3), False, 0, lattice)
    assert len(own.left) == 10
    # The other block of the pair has no vector.
    assert len(lattice_dedup._links(unit, rows, np.full(5, 3), True, 0, lattice).left) == 0
    mixed = lattice_dedup._links(unit, rows, np.array([3, 3, 4, 4, 4]), True, 0, lattice)
    assert len(mixed.left) == 6


@pytest.mark.parametrize("waiting", [1, 50, 200_000])
def test_links_that_wait_are_all_counted(monkeypatch, waiting):
    monkeypatch.setattr(lattice_dedup, "WAITING", waiting)
    draw = np.random.default_rng(5)
    lattice = lattice_dedup.Lattice()
    x = np.repeat(draw.normal(size=(6, 24)), 5, axis=0) + draw.normal(size=(30, 24)) * 0.05
    y = np.repeat(draw.normal(size=(4, 8)), 3, axis=0) + draw.normal(size=(12, 8)) * 0.02
    rows, first = [], 0
    for part in (x, y):
        codes = lattice_dedup.cells(part / np.linalg.norm(part, axis=1, keepdims=True), lattice)
        for i, v in enumerate(part):
            rows += [(int(c), first + i, v.tolist()) for c in np.unique(codes[i])]
        first += len(part)
    # Vectors of another length meet in tasks of their own.
    table = pa.table({"task": [c ^ len(v) for c, _, v in rows], "cell": [c for c, _, _ in rows],
                      "node": [i for _, i, _ in rows], "m": [1] * len(rows), "block": [0] * len(rows),
                      "across": [False] * len(rows),
                      "embedding": [v for _, _, v in rows]})
    found = lattice_dedup._compare(lattice)(table).to_pandas().groupby("node")["n"].sum()
    for part, start in ((x, 0), (y, len(x))):
        unit = part / np.linalg.norm(part, axis=1, keepdims=True)
        near = (unit @ unit.T >= lattice.threshold).sum(1) - 1
        assert [found.get(start + i, 0) for i in range(len(part))] == near.tolist()


@pytest.mark.parametrize("block", [2048, 7])
def test_links_equal_brute_force(spark, block):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 16))
    x = np.repeat(centres, [40, *[3] * 19], axis=0)
    x = x + draw.normal(size=x.shape) * 0.12
    x = np.vstack([x, x[:5], draw.normal(size=(50, 16))]).astype(np.float32)
    labels = [int(v) for v in draw.integers(0, 2, len(x))]
    labels[-5:] = labels[:5] = [1] * 5
    rows = [(i, [float(c) for c in v], label) for i, (v, label) in enumerate(zip(x, labels))]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] * 16, 1),
             (1004, [1.0], 1), (1005, [], 1), (1006, rows[0][1], None), (1007, [float("inf")] * 16, 1),
             (None, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int") \
        .selectExpr("*", "1 AS n_links", "2 AS node")
    got = {r["vec_id"]: r for r in
           lattice_dedup.near_duplicates(df, lattice_dedup.Lattice(block=block)).collect()}
    wide = x.astype(float)
    unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    close = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels))
    links = [(i, j) for i, j in zip(*np.nonzero(np.triu(close, 1)))]
    counts = close.sum(1) - 1
    counts[close[3]] += 1  # the row without an id is a copy of row 3
    low = classes(links, range(len(x)))
    missed = [i for i in range(len(x)) if (got[i]["n_links"], got[i]["component_id"]) != (counts[i], low[i])]
    assert len(missed) <= 0.05 * len(x), missed
    for i in range(1000, 1008):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert lattice_dedup.near_duplicates(df.limit(0)).collect() == []


# --- site quality

def test_posteriors_equal_the_formulas(spark):
    draw = random.Random(5)
    rows = [(i, f"h{min(int(draw.expovariate(0.7)), 4)}", f"p{draw.randrange(3)}", draw.random())
            for i in range(120)] + [(500, "lonely", "", 0.2), (500, "lonely", "", 0.2)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, own double")
    got = {r["doc_id"]: r for r in site_quality.site_posteriors(scored).collect()}
    prior = sum(r[3] for r in rows) / len(rows)
    by_host, by_path = defaultdict(list), defaultdict(list)
    for _, host, path, own in rows:
        by_host[host].append(own)
        by_path[host, path].append(own)

    def strength(groups, mean_of):
        groups = {k: v for k, v in groups.items() if len(v) > 1}
        n = sum(map(len, groups.values()))
        within = sum(sum((x - np.mean(v)) ** 2 for x in v) for v in groups.values()) / (n - len(groups))
        within = max(within, 1e-9)
        between = sum(len(v) * (np.mean(v) - mean_of(k)) ** 2 for k, v in groups.items())
        between = max((between - len(groups) * within) / n, within / 1000)
        return min(1000, within / between)

    k_host = strength(by_host, lambda k: prior)
    k_path = strength(by_path, lambda k: (k_host * prior + sum(by_host[k[0]])) / (k_host + len(by_host[k[0]])))
    for i, host, path, own in rows:
        h = (k_host * prior + sum(by_host[host]) - own) / (k_host + len(by_host[host]) - 1)
        p = (k_path * h + sum(by_path[host, path]) - own) / (k_path + len(by_path[host, path]) - 1)
        assert got[i]["host_posterior"] == pytest.approx(h)
        assert got[i]["path_posterior"] == pytest.approx(p)


def test_quality_of_held_out_documents(spark):
    found = entry.op7_site_quality(spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").df()
    both = found.merge(labels, on="doc_id")
    good, bad = both[both.quality == 1].score, both[both.quality == 0].score
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.85
    assert both[both.quality == 1].kept.mean() > 0.95


def test_awkward_quality_rows(spark):
    docs = frame(spark, AWKWARD).selectExpr("*", "1 AS host", "2 AS own")
    pages = spark.createDataFrame([(4, "http://a.b/c/d"), (4, "http://a.a"), (None, "x"), (5, None), (6, "nonsense")],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(4, 1), (None, 0), (5, None)], "doc_id long, quality int")
    got = site_quality.classify(docs, pages, labels).collect()
    assert len(got) == len(AWKWARD) and {r["host"] for r in got if r["doc_id"] == 4} == {"a.a"}
    assert site_quality.classify(docs.limit(0), pages, labels).collect() == []
    assert len(site_quality.classify(docs, pages.limit(0), labels.limit(0)).collect()) == len(AWKWARD)


# --- mixing

def test_mix_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = duck.execute(entry.ORACLE_SQL["op5_source_mix"]).fetchall()
    got = entry.op5_source_mix(spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_mix_meets_its_targets(spark):
    draw = random.Random(6)
    rows = [(i, "word " * draw.randrange(1, 200), draw.choice(["en", "en", "en", "fr"]),
             draw.choice(["a", "a", "a", "b", "c"]), 1) for i in range(600)]
    targets = source_mix.Targets(dimensions=("source", "lang"), keep=0.3, rounds=20,
                                 shares={"source": {"a": 1, "b": 1, "c": 2}, "lang": {"en": 0.6, "fr": 0.4}})
    got = source_mix.mix(frame(spark, rows), targets).toPandas()
    got["expected"] = got.n_tokens * got.probability
    assert got.expected.sum() == pytest.approx(0.3 * got.n_tokens.sum(), rel=1e-3)
    assert got.probability.between(0, 1).all()
    for column, want in (("source", {"a": 0.25, "b": 0.25, "c": 0.5}), ("lang", {"en": 0.6, "fr": 0.4})):
        shares = got.groupby(column).expected.sum() / got.expected.sum()
        assert shares.to_dict() == pytest.approx(want, rel=0.02)
    assert got[got.sampled].n_tokens.sum() == pytest.approx(got.expected.sum(), rel=0.2)


def test_awkward_mix_rows(spark):
    docs = frame(spark, AWKWARD).selectExpr("*", "1 AS topic", "2 AS sampled", "3 AS mass", "4 AS weight")
    got = source_mix.mix(docs).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["probability"] <= 1 for r in got)
    assert not any(r["sampled"] for r in got if r["n_tokens"] == 0 and r["probability"] == 0)
    assert source_mix.mix(frame(spark, [])).collect() == []


# --- pipeline

def test_stages_do_what_they_say(spark):
    """Each stage on its predecessor's rows, against a plain statement of it."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = frame(spark, [(10_001, None, "en", "src0", 0), (10_002, "123 456", None, "src0", 7),
                          (10_003, "mail me at a.b@c.de for the thing", None, "src0", 33)])
    docs = docs.select(*corpus_pipeline.COLUMNS).unionByName(extra)
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == 5
    kept = steps["language_id"](spark, docs, FOLDER)
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.doc_id for r in docs.collect()} - {10_001, 10_002}
    assert kept.where("lang is null").isEmpty() and kept.columns == corpus_pipeline.COLUMNS

    from tests.llm.test_ngram_join import expected
    rows = [tuple(r) for r in kept.collect()]
    single = steps["ngram_jaccard_join"](spark, kept, FOLDER)
    assert {r.doc_id for r in single.collect()} == {i for i, (_, low) in expected(rows).items() if low == i}
    again = steps["ngram_jaccard_join"](spark, single.unionByName(single), FOLDER)
    assert again.count() == single.count() and single.columns == corpus_pipeline.COLUMNS

    hidden = steps["pii"](spark, single, FOLDER)
    assert hidden.columns == corpus_pipeline.COLUMNS and hidden.count() == single.count()
    assert hidden.where("doc_id = 10003").first().text == "mail me at [EMAIL] for the thing"
    assert hidden.where(r"text rlike '[A-Za-z0-9]@[A-Za-z0-9-]+\\.[A-Za-z0-9]'").isEmpty()
    assert hidden.where("n_chars <> length(text)").isEmpty()

    mixed = steps["source_mix"](spark, hidden, FOLDER)
    assert mixed.columns == corpus_pipeline.COLUMNS
    assert 0.4 * hidden.count() < mixed.count() <= hidden.count()
    ids = steps["bpe_codec"](spark, mixed, FOLDER)
    assert ids.count() == mixed.count() and ids.where("n_tokens <> size(ids)").isEmpty()


def test_whole_pipeline_on_no_rows(spark):
    docs = frame(spark, [])
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
    assert docs.collect() == []
