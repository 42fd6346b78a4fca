"""Nearest vectors against brute force."""

import math

import numpy as np
import pytest

from cellflow.llm import ann
from cellflow.llm.ann import nearest
from cellflow.llm.queries import LLM_QUERIES


def brute(rows, queries, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        score = (x * x[at]).sum(axis=1) / (norm * norm[at])
        score[at] = -2
        best = [b for b in np.lexsort((ids, -score))[:k] if b != at]
        out[q] = [(int(ids[b]), float(score[b])) for b in best]
    return out


def compare(rows, got, want):
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == {q for q, w in want.items() if w}
    hits = 0
    for q, w in want.items():
        own = sorted(by_query.get(q, []), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(w) + 1))
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(own, own[1:]))
        hits += len({r.vec_id for r in own} & {i for i, _ in w})
    return hits / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_recall_of_the_query(spark, sf, scale):
    folder = sf.replace("0.001", scale)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0])
    got = LLM_QUERIES["op4_nearest_vectors"](spark, folder).collect()
    assert compare(rows, got, want) >= 0.93
    x = {i: np.array(v, dtype=np.float64) for i, v in rows}
    assert all(math.isclose(r.score, x[r.query_id] @ x[r.vec_id] / np.linalg.norm(x[r.query_id]) / np.linalg.norm(x[r.vec_id]), rel_tol=1e-12) for r in got)


def test_identical_vectors_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTORS", 40)
    monkeypatch.setattr(ann, "QUERIES", 4)
    rng = np.random.default_rng(1)
    hot = rng.standard_normal(12).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.standard_normal(12).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    want = brute(rows, range(0, 900, 50))
    got = nearest(frame, "vec_id % 50 = 0").collect()
    assert compare(rows, got, want) >= 0.9
    own = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 150, 300)}
    assert own[0] == [3, 6, 9, 12, 15] and own[150] == own[300] == [0, 3, 6, 9, 12]


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]),
            (6, [1.0, 1.0]), (7, [1.0]), (None, [1.0, 2.0]), (6, [1.0, 1.0]), (100, []), (8, [-1.0, -0.0])]
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id bigint, embedding array<float>, list string, v string")
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in nearest(frame, "vec_id % 50 = 0").collect())
    assert got == [(0, 1, 50, 1.0), (0, 2, 6, 0.707107), (0, 3, 8, -1.0), (50, 1, 0, 1.0), (50, 2, 6, 0.707107), (50, 3, 8, -1.0)]
    assert nearest(frame.limit(0), "true").count() == 0
    assert nearest(frame.where("vec_id = 0"), "true").count() == 0
