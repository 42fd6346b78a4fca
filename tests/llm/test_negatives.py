"""Hard negatives against SQL and brute force."""

import numpy as np
import pytest
from llm_helpers import duck, same_rows
from pyspark.sql import functions as F

from cellflow.llm import negatives
from cellflow.llm.negatives import Search, Tree, hard_negatives, tiled
from cellflow.llm.oracles import LLM_ORACLES
from cellflow.llm.queries import LLM_QUERIES


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_against_sql(spark, sf, scale):
    folder = sf.replace("0.001", scale)
    same_rows(LLM_QUERIES["op12_hard_negatives"](spark, folder), duck(folder), LLM_ORACLES["op12_hard_negatives"])


def brute(rows, ask):
    """rows: (id, label, vector) that take part; scores in Python's whole numbers."""
    rows = [(i, label, [int(np.floor(256 * float(c))) for c in v]) for i, label, v in rows]
    out = []
    for a, label, v in rows:
        if not ask(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, other, w in rows if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            fit = [(i, -t) for t, i, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, k + 1, i, -s, t) for k, (i, t) in enumerate(fit[:3])]
    return sorted(out)


SCHEMA = "vec_id bigint, label int, embedding array<double>"


def run(frame, anchors):
    return sorted(tuple(r) for r in hard_negatives(frame, anchors, F.col("label")).collect())


@pytest.mark.parametrize("labels, hot, scale", [(3, 0, 1.0), (40, 3, 0.02), (2, 2, 1000.0)])
def test_ties_small_tiles_and_hot_vectors(spark, monkeypatch, labels, hot, scale):
    for name, value in (("TILE", 50), ("LEAF", 7), ("FAN", 3), ("ANCHORS", 5)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(labels)
    same = (rng.standard_normal(6) * scale).tolist()
    rows = [(i, int(rng.integers(labels)), same if hot and i % hot == 0 else np.round(rng.standard_normal(6) * scale, 2).tolist()) for i in range(400)]
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(3), "vec_id % 10 = 0")
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.7, 0.1]), (3, 2, [0.7, 0.1]), (4, 3, [-1.0, -1.0]), (5, 1, [-1.0, 0.0]), (10, 9, [0.0, 0.0]), (20, 1, [0.8, 0.4])]
    bad = [(6, None, [1.0, 1.0]), (7, 1, None), (8, 1, [nan, 1.0]), (9, 2, [inf, 1.0]), (11, 2, [1.0, None]), (None, 2, [1.0, 1.0]), (12, 2, [1.0]), (13, 2, []),
           (14, 2, [1e30, 1.0]), (0, 7, [9.0, 9.0]), (1, 1, [0.9, 0.5])]
    frame = spark.createDataFrame([(*r, "x", "x") for r in good + bad], SCHEMA + ", tile string, score string")
    assert run(frame, "vec_id % 10 = 0") == brute(good, lambda i: i % 10 == 0)
    assert run(frame.limit(0), "true") == []
    assert run(frame.where("vec_id = 0"), "true") == []
    assert run(frame, "false") == []


def test_pruning_loses_nothing_and_skips_nodes():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 3)) * 2000
    vectors = np.floor(np.concatenate([c + rng.standard_normal((200, 3)) * 20 for c in centres])).astype(np.int64)
    ids, labels = np.arange(len(vectors)), rng.integers(0, 4, len(vectors))
    tree, visited = Tree(ids, labels, vectors, leaf=16, fan=4), []
    scores = tree.scores
    tree.scores = lambda leaf, anchor: (visited.append(leaf), scores(leaf, anchor))[1]
    for a in range(0, len(vectors), 100):
        exact = vectors @ vectors[a]
        low, high = np.array([exact.max() // 2]), np.array([exact.max() * 19 // 20])
        bounds = tree.bounds(vectors[a:a + 1])
        got = Search(tree, 3, False).run(a, vectors[a], labels[a], bounds, 0, low, high)[0]
        want = sorted((-int(s), int(i)) for i, s in zip(ids, exact) if labels[i] != labels[a] and low[0] <= s <= high[0])[:3]
        assert got == want
        assert (bounds[-1][0][0, 0] <= exact.min()) and (bounds[-1][1][0, 0] >= exact.max())
    assert len(visited) < 16 * len(tree.levels[0][0]) / 4
    assert sorted(np.concatenate(tiled(np.arange(1000), [rng.random(1000), rng.random(1000)], 16)).tolist()) == list(range(1000))
