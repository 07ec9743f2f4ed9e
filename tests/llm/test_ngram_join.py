"""The n-gram join against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from llm import common, ngram_join
from llm.ngram_join import Join, jaccard_components, one_of_each, pivot_links
from tests.llm.helpers import AWKWARD, classes, frame, prose


def shingles(text: str | None) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def expected(rows) -> dict[int, tuple[int, int]]:
    sets = {r[0]: shingles(r[1]) for r in rows}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    low = classes(links, sets)
    return {i: (len(s), low[i]) for i, s in sets.items()}


def corpus(seed: int, groups: int = 12, unrelated: int = 40):
    """Near-copy groups, one of them large, and a passage that many texts share."""
    draw = random.Random(seed)
    passage = prose(draw, 30)
    texts = [prose(draw, 40) + " " + passage + " " + prose(draw, 20) for _ in range(unrelated)]
    for g in range(groups):
        base = prose(draw, draw.randrange(20, 120)).split(" ")
        for _ in range(40 if g == 0 else draw.randrange(2, 6)):
            copy = list(base)
            for _ in range(draw.randrange(0, 4)):
                copy[draw.randrange(len(copy))] = prose(draw, 1)
            texts.append(" ".join(copy))
    texts += [texts[0].upper(), texts[-1], "few words", "Few words", passage]
    draw.shuffle(texts)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def result(df) -> dict:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("join", [
    Join(), Join(leaf_shingles=300, pivots=3), Join(id_bytes=1), Join(id_bytes=1, leaf_shingles=300)])
def test_equals_brute_force(spark, join):
    rows = corpus(1)
    assert result(jaccard_components(frame(spark, rows).repartition(5), join)) == expected(rows)


def test_awkward_rows(spark):
    rows = AWKWARD + [(10, "a text without an id that is long enough to have shingles", "e", "s", 1)]
    got = jaccard_components(
        frame(spark, rows).selectExpr("*", "1 AS n", "'x' AS shingles", "2 AS component_id")).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["n_shingles"] for i in (1, 2, 3, 4, 6, 7)] == [0, 0, 0, 1, 1, 1]
    assert [by_id[i]["component_id"] for i in (1, 2, 3, 5, 7)] == [1, 2, 3, 4, 7]
    assert by_id[None]["component_id"] == 10 and by_id[9]["n_shingles"] == 1


def chain(draw, n: int, step: int, words: int = 100) -> list[str]:
    """Texts that link with their neighbours only."""
    base = [prose(draw, 1) + str(i) for i in range(words)]
    texts = []
    for k in range(n):
        base = [f"{w}x{k}" if (k - 1) * step <= i < k * step else w for i, w in enumerate(base)]
        texts.append(" ".join(base))
    return texts


def unnamed(rows, missing):
    return [(None if r[0] in missing else r[0], *r[1:]) for r in rows]


@pytest.mark.parametrize("missing", [{1}, {0}, {0, 2}, {0, 1, 2}, {0, 1, 2, 3}])
def test_rows_without_an_id_link(spark, missing):
    texts = chain(random.Random(11), 3, 9)
    sets = [shingles(t) for t in texts]
    assert 100 * len(sets[0] & sets[2]) < 75 * len(sets[0] | sets[2])
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*texts, texts[1], "alone among others here and now"])]
    got = jaccard_components(frame(spark, unnamed(rows, missing)).repartition(3)).collect()
    ids = {i for i in range(4)} - missing
    low = min(ids, default=None)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["component_id"]) for r in got if r["doc_id"] != 4) == sorted(
        (i in missing, None if i in missing else i, low) for i in range(4))
    left = one_of_each(frame(spark, unnamed(rows, missing)).repartition(3)).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == sorted(({low} - {None}) | {4})
    assert len(left) == 2


def test_many_rows_without_an_id(spark):
    rows = corpus(7, groups=5, unrelated=10)
    missing = {i for i, *_ in rows if i % 3}
    got = jaccard_components(frame(spark, unnamed(rows, missing)).repartition(4)).collect()
    want = expected(rows)
    low = {}
    for i, (_, c) in want.items():
        if i not in missing:
            low[c] = min(i, low.get(c, i))
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(
        str((None if i in missing else i, n, low.get(c))) for i, (n, c) in want.items())


def test_choice_is_by_row(spark):
    near = chain(random.Random(12), 2, 4)
    rows = [(1, near[0], "en", "a", 1), (1, "quite another text under the same id", "en", "a", 1),
            (1, near[1], "en", "b", 1), (None, "a first text that has no id at all", "en", "a", 1),
            (None, "a second text that also lacks one", "en", "a", 1), (2, near[1], "en", "a", 1),
            (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, None, None, None, 0),
            (6, "twice twice", "en", "a", 0), (6, "twice twice", "en", "a", 0)]
    docs = frame(spark, rows).selectExpr("*", "1 AS root", "2 AS text_key", "3 AS _extra").repartition(3)
    left = one_of_each(docs)
    assert left.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert len(kept) == len(set(kept)) == 8
    assert sum(t in near for _, t in kept) == 1
    assert {t for i, t in kept if i is None} == {rows[3][1], rows[4][1]}


def test_frequent_shingles_are_found_over_batches(monkeypatch):
    monkeypatch.setattr(ngram_join, "SKETCH_KEYS", 50)
    draw = np.random.default_rng(2)
    batches = [pa.record_batch({"shingles": pa.array(
        [np.r_[7, draw.integers(100, 1 << 40, 30)].astype(np.int64).tobytes()], pa.binary())})
        for _ in range(40)]
    found = next(ngram_join._often(batches))
    assert 7 in found.column("key").to_pylist() and found.num_rows <= 50


def test_empty_table(spark):
    assert jaccard_components(frame(spark, [])).collect() == []


def test_pivots_of_a_cell_connect_what_all_links_connect():
    draw = np.random.default_rng(3)
    join = Join()
    for _ in range(30):
        centres = [draw.choice(500, 60, replace=False) for _ in range(3)]
        sets = []
        for _ in range(25):
            keep = centres[draw.integers(3)][draw.random(60) > draw.random() * 0.25]
            sets.append(np.unique(np.r_[keep, draw.choice(500, draw.integers(0, 12))]))
        links = [(a, b) for a, b in combinations(range(25), 2)
                 if join.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))]
        found = pivot_links(np.arange(25), sets, join)
        assert set(map(frozenset, found)) <= set(map(frozenset, links))
        assert classes(found, range(25)) == classes(links, range(25))
        side = draw.integers(0, 2, 25)
        between = pivot_links(np.arange(25), sets, join, side)
        assert classes(between, range(25)) == classes(
            [(a, b) for a, b in links if side[a] != side[b]], range(25))


def test_smallest_reachable(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(100, b) for b in range(101, 160)]
    got = common.smallest_reachable(
        spark.createDataFrame([*edges, (None, 3), (4, None), (7, 7)], "a long, b long"), "t").collect()
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    low = classes(edges, {n for e in edges for n in e})
    assert {r["node"]: r["component"] for r in got} == {n: low[n] for n in nodes}
    assert len(got) == len(nodes)
    assert common.smallest_reachable(spark.createDataFrame([], "a long, b long"), "t").collect() == []


def graded(draw, n: int = 250, words: int = 60) -> list[np.ndarray]:
    """Sets from copies to strangers of one base: regions around them hold nearly all of them."""
    base = draw.choice(400, words, replace=False)
    return [np.unique(np.r_[base[draw.random(words) > 0.6 * i / n], draw.choice(400, 60 * i // (100 * n) + 8)])
            for i in range(n)]


def test_a_cell_that_regions_do_not_shrink_is_not_multiplied(spark, monkeypatch):
    sets = graded(np.random.default_rng(8))
    join = Join(leaf_shingles=3000)
    weight = sum(map(len, sets))
    cells = spark.createDataFrame([(1, i, len(s)) for i, s in enumerate(sets, 1)], "cell long, doc_id long, n long")
    held = spark.createDataFrame([(i, len(s), s.astype(np.int64).tobytes()) for i, s in enumerate(sets, 1)],
                                 "doc_id long, n long, shingles binary")
    staged = {}

    def noted(df, name):
        out = stage(df, name)
        staged[name] = staged.get(name, 0) + out.count()
        return out

    stage = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", noted)
    links = [(r["a"], r["b"]) for r in ngram_join.cell_links(cells, held, join).collect()]
    want = [(a, b) for a, b in combinations(range(1, len(sets) + 1), 2) if join.linked(
        len(np.intersect1d(sets[a - 1], sets[b - 1])), len(sets[a - 1]), len(sets[b - 1]))]
    assert len(want) > 50 and set(map(frozenset, links)) <= set(map(frozenset, want))
    ids = range(1, len(sets) + 1)
    assert classes(links, ids) == classes(want, ids) and len(set(classes(want, ids).values())) > 1
    # Rows of one round of regions, and of every pair of blocks.
    assert staged["jaccard_dealt"] <= join.pivots * len(sets)
    monkeypatch.setattr(ngram_join, "_join_cell", lambda join: lambda group: pa.table(
        {"a": pa.array([group.num_rows], pa.int64()), "b": pa.array([0], pa.int64())}))
    tasks = ngram_join.cell_links(cells, held, join).where("b = 0").agg({"a": "sum"}).first()[0]
    assert tasks <= len(sets) * -(-2 * weight // join.leaf_shingles)


def test_strangers_of_a_cell_are_not_compared(monkeypatch):
    """All sets hold half of one base; only the first forty are near it."""
    draw = np.random.default_rng(9)
    sets = [np.flatnonzero(draw.random(300) > 0.05) for _ in range(40)]
    sets += [np.r_[draw.choice(300, 150, replace=False), draw.choice(10**4, 130, replace=False) + 300]
             for _ in range(360)]
    compared = []
    shared = ngram_join._Sets.shared
    monkeypatch.setattr(ngram_join._Sets, "shared",
                        lambda self, pivot, members: compared.append(len(members)) or shared(self, pivot, members))
    found = pivot_links(np.arange(400), sets, Join())
    assert len(found) == 39 and classes(found, range(400)) == {i: 0 if i < 40 else i for i in range(400)}
    assert sum(compared) < 400 * 400 / 2 / 20
