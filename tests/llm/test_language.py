"""The recurrent network: gradients, held-out accuracy, cases."""

import zlib

import numpy as np
import pyarrow as pa
from llm_helpers import CLASHES, documents

from cellflow.llm import language as L
from cellflow.llm.queries import LLM_QUERIES


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    model = L.fresh(["a", "b", "c"])
    for name in ("inputs", "recurrent", "outputs", "bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    codes, target = rng.integers(0, 256, (6, 5)), rng.integers(0, 3, 5)
    _, grads = L.gradients(model, codes, target)
    for p, g in zip(model.parameters, grads, strict=True):
        for at in np.argsort(-np.abs(g).ravel())[:4]:
            spot, before = np.unravel_index(at, g.shape), p.flat[at]
            found = []
            for step in (1e-3, -1e-3):
                p[spot] = before + step
                found.append(L.gradients(model, codes, target)[0])
            p[spot] = before
            assert abs((found[0] - found[1]) / 2e-3 - g[spot]) < 2e-3 * max(1.0, abs(g[spot]))


def test_windows_do_not_depend_on_what_is_read_together():
    model = L.fresh(["a", "b"])
    texts = [None, "", "x", "é" * 500, "word " * 200, "y" * 64, "z" * 129]
    together = L.probabilities(model, pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(L.probabilities(model, pa.array([t], pa.string()))[0], together[i], atol=1e-5)
        assert np.isclose(together[i].sum(), 1 if t else 0, atol=1e-4)


def test_held_out_accuracy(spark, sf):
    rows = LLM_QUERIES["op2_language"](spark, sf.replace("0.001", "0.01")).collect()
    table = {r.doc_id: r for r in spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet").collect()}
    assert len(rows) == len(table)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == table[r.doc_id].lang for r in own]) >= 0.97


def test_cases(spark):
    docs = documents(spark, [None, "", "123 !?", "the house is red " * 5, "é"] * 2, ids=[*range(9), None], extra=CLASHES)
    got = {(r.doc_id, r.lang_pred) for r in L.identify(docs, L.learn(docs)).collect()}
    assert len(got) == 10 and {(0, "und"), (1, "und"), (2, "und"), (3, "en"), (4, "en")} <= got
    kept = L.keep_known(docs, L.learn(docs))
    assert kept.columns == docs.columns and kept.where("text LIKE 'the%'").count() == 2 and kept.where("text IS NULL").count() == 0
    nothing = docs.limit(0)
    assert L.learn(nothing) is None and L.identify(nothing, None).count() == 0
    assert {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}


def test_every_label_is_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "STEPS", 5)
    names = [f"l{k:03d}" for k in range(100)]
    rows = [(n * 100 + k, f"text number {k} of some label", name) for n in range(30) for k, name in enumerate(names)]
    rows += [(10_000 + i, "a frequent label", "hot") for i in range(3000)]
    docs = spark.createDataFrame([(i, t, name, "s", len(t)) for i, t, name in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    taken = {}
    monkeypatch.setattr(L, "trained", lambda texts, labels: taken.update({k: labels.count(k) for k in set(labels)}))
    L.learn(docs)
    assert set(taken) == {*names, "hot"}
    assert taken["hot"] == L.SAMPLE // 101 and all(1 <= taken[k] <= L.SAMPLE // 101 for k in names)
    monkeypatch.setattr(L, "SAMPLE", 50)  # fewer rows than labels: one each
    taken.clear()
    L.learn(docs)
    assert set(taken) == {*names, "hot"} and set(taken.values()) == {1}
