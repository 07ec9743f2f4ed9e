"""Exact search against brute force."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from llm import pivot_search
from llm.pivot_search import LONG, Search, farthest_first, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, settings=Search()):
    sound = []
    for vec_id, x, *_ in rows:
        if vec_id is not None and x is not None and all(
                c is not None and math.isfinite(settings.scale * c) for c in x):
            sound.append((vec_id, [math.floor(settings.scale * c) for c in x]))
    out = []
    for q, (query, v) in enumerate(sound):
        if query % settings.every:
            continue
        found = sorted(
            (-max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(v, w)))), i)
            for k, (i, w) in enumerate(sound) if k != q and len(w) == len(v))
        out += [(query, k, i, -s) for k, (s, i) in enumerate(found[: settings.k], 1)]
    return sorted(out)


def vectors(seed=4, n=400, size=12, clusters=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, size))
    x = centres[draw.integers(0, clusters, n)] + draw.normal(scale=0.2, size=(n, size))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    x[n // 2 : n // 2 + n // 3] = x[0]  # a third are one vector
    return [(int(i), x[i].tolist(), 0) for i in draw.permutation(n)]


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("settings", [
    Search(), Search(block=40, span=80, every=7), Search(k=30, block=16, span=32, pivots=2, chunks=3),
    Search(k=1, sample=0, block=64, every=1)])
def test_equals_brute_force(spark, settings):
    rows = vectors()
    found = top_k(spark.createDataFrame(rows, SCHEMA).repartition(5), settings)
    assert result(found) == expected(rows, settings)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(n=60, size=3) + [
        (100, None, 1), (150, [1.0, None, 2.0], 1), (200, [nan, 1.0, 1.0], None), (250, [inf, 0.0, 0.0], 1),
        (300, [], 1), (301, [], None), (350, [0.0, 0.0, 0.0], 1), (400, [1.0, 2.0], 1),
        (401, [-0.5, 0.001], 1), (450, [1.0], 1), (None, [1.0, 1.0, 1.0], 1), (-50, [0.5, -0.5, 0.25], 1),
        (350, [0.0, 0.0, 0.0], 1), (350, [1.0, 0.0, 0.0], 1)]
    settings = Search(block=8, span=16)
    assert result(top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), settings)) == expected(rows, settings)


def test_large_components(spark):
    draw = random.Random(6)
    rows = [(i, [draw.choice([1, -1]) * 10.0 ** draw.choice([0, 5, 9, 12, 160, 305, 307]) for _ in range(4)])
            for i in range(80)]
    settings = Search(every=5, block=16, span=32)
    found = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), settings)
    assert result(found) == expected(rows, settings)


def test_empty_and_clashing(spark):
    assert result(top_k(spark.createDataFrame([], SCHEMA))) == []
    rows = [(50, [1.0, 2.0], "a", "b"), (1, [3.0, 1.0], "c", "d")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, position string")
    assert result(top_k(df)) == expected(rows)
    assert result(top_k(df.limit(1))) == []


def test_bounds_leave_candidates_out():
    rows = vectors(n=4000, size=8, clusters=20)
    x = np.floor(256 * np.array([r[1] for r in rows], np.float64))
    pivots = farthest_first(x[:500], 24)
    held = pivot_search.Rows(np.arange(len(x)), np.array([r[0] for r in rows]), x,
                             pivot_search.distances(x, pivots), (x * x).sum(1))
    share = [pivot_search.search(q, held, held, 5, -np.inf)[2] / len(x) for q in range(0, len(x), 100)]
    assert np.mean(share) < 0.5
    for q in range(0, len(x), 400):
        best, value, _ = pivot_search.search(q, held, held, 5, -np.inf)
        own = x @ x[q]
        own[q] = -np.inf
        assert value.tolist() == np.sort(own)[::-1][:5].tolist()


def test_sql():
    rows = vectors(n=200)
    settings = Search(every=9)
    with duckdb.connect() as db:
        db.register("embeddings", pa.table({
            "vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))}))
        assert sorted(db.sql(pivot_search.oracle_sql(settings)).fetchall()) == expected(rows, settings)
