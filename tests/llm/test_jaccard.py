"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import CLASHES, documents, duck, same_rows

from cellflow.llm import common, jaccard, language, packing
from cellflow.llm.components import components
from cellflow.llm.jaccard import near_duplicates, signatures
from cellflow.llm.oracles import LLM_ORACLES
from cellflow.llm.queries import LLM_QUERIES, byte_vocabulary
from cellflow.llm import shingles as shingles_module
from cellflow.llm.shingles import Sets, shingle_sets


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """{id: component} and the sizes of the rows."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if i is None or j is None or not x or not y or 4 * min(len(x), len(y)) < 3 * max(len(x), len(y)):
                continue
            n = len(x & y)
            if 100 * n >= 75 * (len(x) + len(y) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in parent}, sorted(((i, len(s)) for i, s in sets), key=str)


def check(docs, rows):
    got = near_duplicates(docs).collect()
    component, sizes = brute(rows)
    assert sorted(((r.doc_id, r.n_shingles) for r in got), key=str) == sizes
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == component
    assert all(r.component_id is None for r in got if r.doc_id is None)


def corpus(rng):
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(70))
    texts = []
    for _ in range(60):
        base = [word() for _ in range(rng.choice([1, 3, 5, 6, 7, 9, 12, 20, 40, 90, 200]))]
        for _ in range(rng.randint(1, 6)):
            other = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(len(other))
                other[at:at + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
                other = other or [word()]
            texts.append(" ".join(other))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randint(5, 90))) for _ in range(60)]
    chain = [word() for _ in range(60)]
    for k in range(30):  # neighbours are similar, ends are not
        texts.append(" ".join(chain))
        chain[(2 * k) % 60] = word()
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed, monkeypatch):
    rng = random.Random(seed)
    if seed == 2:
        monkeypatch.setattr(jaccard, "BLOCK", 4)
        monkeypatch.setattr(jaccard, "COMMON", 6)
    texts = corpus(rng)
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    check(documents(spark, texts, ids, extra=CLASHES).repartition(4), list(zip(ids, texts)))


def test_cases(spark):
    texts = [None, "", " \n", "A b", "a  B", "a b c", "x " * 300, "x " * 4000, "one two three four five six", None, "a b"]
    ids = [9, 8, 7, 6, 5, 4, 3, 2, 1, None, None]
    check(documents(spark, texts, ids), list(zip(ids, texts)))
    assert near_duplicates(documents(spark, ["a"]).limit(0)).count() == 0


def test_repeated_ids(spark):
    texts = ["a b c d e f g h i j", "k l m n o p", "a b c d e f g h i j", "k l m n o p", "a b c d e f g h i j k"]
    ids = [7, 7, 7, 3, 5]
    check(documents(spark, texts, ids), list(zip(ids, texts)))


def test_every_similar_pair_shares_a_signature():
    """The pigeonhole itself, on random sets of every size, with and without skipped signatures."""
    rng = np.random.default_rng(4)
    for s in [*range(3, 40), 64, 99, 150, 400]:
        for _ in range(12):
            x = rng.integers(0, 1 << 63, s, dtype=np.uint64)
            most = s // 7 * 2 + 3
            for _ in range(4):
                drop, add = rng.integers(0, min(s, most), 2)
                y = np.concatenate([x[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
                n, u = s - drop, s + add
                if not len(y) or 4 * n < 3 * u:
                    continue
                sets = Sets(0, np.array([s, len(y)]), np.concatenate([np.sort(x), np.sort(y)]))
                text, found, _ = signatures(sets, np.zeros(0, np.uint64))
                if s == len(y) == n:
                    continue
                assert set(found[text == 0]) & set(found[text == 1]), (s, len(y))
                common = np.unique(rng.choice(found, max(1, len(found) // 3)))
                text, found, _ = signatures(sets, common)
                assert set(found[text == 0]) & set(found[text == 1]), (s, len(y), "skipped")


def histogram_rows(texts, shingles, most):
    (sets,) = list(shingle_sets(pa.array(texts)))
    return sets, [np.frombuffer(h, dtype=np.uint8) for h in jaccard._histograms(sets, shingles, most)]


def test_histograms_discard_no_similar_pair():
    rng = random.Random(3)
    long = [f"w{rng.randrange(10**6)}" for _ in range(9000)]
    texts = []
    for size in (6, 100, 600, 2500, 9000):
        for cut in (0, size // 30, size // 12):
            words = long[:size]
            for _ in range(cut // 4):
                words[rng.randrange(size)] = "other"
            texts.append(" ".join(words[: size - cut]))
    texts += ["same " * 3000, "a b c d e f g h " * 400]
    sets, coarse = histogram_rows(texts, jaccard.SHARE, jaccard.MOST_COARSE)
    assert len({len(h) for h in coarse}) >= 4
    parts = np.split(sets.hashes, sets.starts[1:-1])
    for i, x in enumerate(parts):
        for j, y in enumerate(parts[:i]):
            bins = min(len(coarse[i]), len(coarse[j]))
            gap = np.abs(jaccard.folded(coarse[i], bins) - jaccard.folded(coarse[j], bins)).sum(dtype=np.int64)
            assert gap <= len(np.setxor1d(x, y))
    unlike = [" ".join(f"{k}-{rng.randrange(10**6)}" for _ in range(4000)) for k in range(2)]
    sets, (x, y) = histogram_rows(unlike, jaccard.SHARE, jaccard.MOST_COARSE)
    assert np.abs(jaccard.folded(x, 1024) - jaccard.folded(y, 1024)).sum() > jaccard.differ_most(*sets.sizes)  # 128 bins could not tell
    full = np.array([250, 9, 255, 255] * 64, dtype=np.uint8)
    assert jaccard.folded(full, 128).max() == 255 and jaccard.folded(full, 256).tolist() == full.tolist()


def test_shingle_sets_in_pieces():
    texts = [None, "", "a", "b c d e f g b c d e f g", "É é " * 10, *["w%d " % i * 9 + "z" * 300_000 for i in range(9)]]
    sizes = [int(n) for s in shingle_sets(pa.array(texts)) for n in s.sizes]
    assert sizes == [len(shingles(t)) for t in texts]


def thue_morse(n):
    word, other = "a", "b"
    while len(word) < n:
        word, other = word + other, other + word
    return word, other


@pytest.mark.parametrize("n", [2048, 4096])
def test_words_that_any_polynomial_of_a_power_of_two_confuses(spark, n):
    word, other = thue_morse(n)
    rest = " ".join(f"w{i}" for i in range(9))
    texts = [f"{word} {rest}", f"{other} {rest}", f"{word} {other} {rest}", f"{word} x1 x2 x3 x4 {other} x1 x2 x3 x4"]
    texts += [" ".join([word, "p", "q", "r", "s"]), " ".join([other, "p", "q", "r", "s"])]
    check(documents(spark, texts), list(enumerate(texts)))


def test_words_are_compared(monkeypatch):
    texts = pa.array(["Some words and some WORDS", None, "", "other words", "é" * 400])
    assert not shingles_module.words_collide(texts) and not shingles_module.words_collide(texts.slice(1, 2))
    monkeypatch.setattr(shingles_module, "PIECE", 7)
    assert not shingles_module.words_collide(texts)
    pairs = [(1, 2, "a b c d e f", "A b c d e f"), (3, 4, "a b c d e f", "g h i j k l"), (5, 6, None, "")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs)], ["a", "b", "text_a", "text_b"])
    want = [{"a": 1, "b": 2}]
    assert [r for out in jaccard.similar(iter([batch])) for r in out.to_pylist()] == want
    monkeypatch.setattr(shingles_module, "_BYTE", np.ones(256, np.uint64))  # words of one length have one hash
    assert shingles_module.words_collide(pa.array(["ab cd"])) and not shingles_module.words_collide(pa.array(["ab AB"]))
    assert [r for out in jaccard.similar(iter([batch])) for r in out.to_pylist()] == want


def test_long_pairs_are_compared_a_bounded_part_at_a_time(monkeypatch):
    """A worker's memory follows the bytes of a part, not its pairs."""
    rng = random.Random(5)
    short = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(9)) for _ in range(600)]
    long = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12_000)) for _ in range(40)]
    huge = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200_000))
    texts = [*short[:300], *long, huge, None, *short[300:]]
    pairs = [(k, k + 1000, t, t if k % 3 else "other words") for k, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs)], ["a", "b", "text_a", "text_b"])
    met, real = [], jaccard.words_collide
    monkeypatch.setattr(jaccard, "words_collide", lambda t: (met.append((len(t) // 2, sum(len(x or "") for x in t.to_pylist()))), real(t))[1])
    got = [r["a"] for out in jaccard.similar(iter([batch, batch.slice(0, 0)])) for r in out.to_pylist()]
    assert got == [k for k, t in enumerate(texts) if k % 3 and t]
    assert sum(n for n, _ in met) == len(texts) and max(n for n, _ in met) <= 256
    assert all(size <= shingles_module.PIECE for n, size in met if n > 1)


def test_batches_with_python_are_bounded_in_bytes(spark, monkeypatch):
    """Every job with Python of the stages that send whole texts runs with small batches, and their borders change no result."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    with common.arrow_bytes(spark, 50_000):
        found = [r.n for r in spark.range(0, 1000, 1, 1).selectExpr("repeat('x', 1000) AS t").mapInArrow(sizes, "n bigint").collect()]
    assert max(found) < 60_000 and len(found) > 15 and spark.conf.get(name) == before
    seen = []

    def recorded(frame, label):
        seen.append((label, spark.conf.get(name)))
        return common.stored(frame, label)

    monkeypatch.setattr(common, "BATCH_BYTES", 700)
    for module in (jaccard, language, packing):
        monkeypatch.setattr(module, "stored", recorded)
    texts = corpus(random.Random(6))
    docs = documents(spark, texts).repartition(3)
    check(docs, list(enumerate(texts)))
    model = language.trained(["abc", "de"], ["x", "y"], steps=1)
    assert language.keep_known(docs, model, min_score=0.0).count() == len(texts)
    packing.tokenised(docs.select(docs.doc_id.alias("id"), "text"), *byte_vocabulary(), 64)
    assert {"sets", "shared", "links", "known", "tokens"} <= {label for label, _ in seen}
    assert {size for _, size in seen} == {"700"} and spark.conf.get(name) == before


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(230)] + [(500 + i, 501 + i) for i in range(40)] + [(9, 9)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {n: n for e in edges for n in e}
    for _ in range(60):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    ties = {n for e in edges for n in e if e[0] != e[1]}
    assert got == {n: parent[n] for n in ties}


def test_query(spark, sf):
    same_rows(LLM_QUERIES["op3_jaccard_join"](spark, sf), duck(sf), LLM_ORACLES["op3_jaccard_join"])
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    component, _ = brute(rows)
    assert {r.doc_id: r.component_id for r in LLM_QUERIES["op3_jaccard_join"](spark, sf).collect()} == component
