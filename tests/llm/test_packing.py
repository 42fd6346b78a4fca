"""Packing: every id in exactly one piece, full sequences, ids of the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
from llm_helpers import CLASHES, documents
from tokenizers import Tokenizer

from cellflow.llm.packing import Index, encoder, pack
from cellflow.llm.queries import LLM_QUERIES, byte_vocabulary


def ids_by_library(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*e.ids, 0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, table, window=1024):
    """rows of the result against {doc_id: ids}."""
    for r in rows:
        own = table[r.doc_id]
        assert r.doc_tokens == len(own)
        assert zlib.crc32(np.array(own[r.start:r.start + r.length], dtype="<u4").tobytes()) == r.ids_crc32
    covered = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == covered.get(r.doc_id, 0) and r.length > 0
        covered[r.doc_id] = r.start + r.length
    assert covered == {d: len(i) for d, i in table.items()}
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and at & (at - 1) == 0
    return by_sequence


TEXTS = [None, "", " ", "a", "a  b\n\n c", "<|endoftext|> x <|end", "é😀 " * 700, "x" * 9000, "the " * 5000, "don't we'll\t\r\n", "ſt ﬁ 　x\x00"]


def test_cases(spark):
    docs = documents(spark, TEXTS * 2, extra=CLASHES).repartition(3)
    table = dict(enumerate(ids_by_library(TEXTS * 2)))
    check(pack(docs, *byte_vocabulary(), shard=5).collect(), table)
    assert pack(documents(spark, ["a"]).limit(0), *byte_vocabulary()).count() == 0
    again = pack(documents(spark, ["a b", "a b", None], ids=[1, 1, None]), *byte_vocabulary()).collect()
    assert sum(r.length for r in again) == 7


def test_neighbours_share_words(spark):
    words = ["alpha beta gamma delta", "red green blue yellow", "north south east west"]
    docs = documents(spark, [" ".join([words[i % 3]] * 25) for i in range(60)])
    pieces = pack(docs, *byte_vocabulary()).collect()
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append(r.doc_id % 3)
    pure = [len(set(v)) == 1 for v in by_sequence.values() if len(v) > 2]
    assert np.mean(pure) > 0.5


def test_neighbours_are_found_beyond_a_shard_of_the_input(spark):
    """40 groups of 6 documents, spread over the input; a shard holds 24 rests."""
    rng = np.random.default_rng(5)
    words = [w for w in Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).get_vocab() if w.isascii() and w.isalpha() and len(w) > 3]
    words = rng.permutation(sorted(words))
    own, noise = words[:160].reshape(40, 4), words[160:460]

    def text(group):
        return " ".join(rng.permutation([*np.repeat(own[group], 10), *rng.choice(noise, 100)]))

    docs = documents(spark, [text(i % 40) for i in range(240)]).repartition(3)
    rows = pack(docs, *byte_vocabulary(), shard=24).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, set()).add(r.doc_id)
    windows = [v for v in by_sequence.values() if len(v) > 2]
    together = [sum(a % 40 == b % 40 for a in v for b in v if a < b) / (len(v) - 1) for v in windows]
    assert len(windows) > 20 and np.mean(together) > 0.5  # 0.05 if shards are drawn at random


def test_scores_are_of_the_whole_query():
    rng = np.random.default_rng(3)
    rests = [np.sort(rng.choice(np.arange(1, 400), rng.integers(1, 150))).astype("<u2") for _ in range(60)]
    weight = np.linspace(0.1, 9, 1 << 16 | 1).astype(np.float32)
    index = Index(rests, weight, 70.0)
    for i in (0, 7, 59):
        want = [sum(float(weight[t]) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(r) / 70)) for t in set(rests[i].tolist()) if (n := int((r == t).sum())))
                for r in rests]
        np.testing.assert_allclose(index.scores(i), want, rtol=1e-4)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    table = dict(zip([r.doc_id for r in docs], ids_by_library([r.text for r in docs])))
    by_sequence = check(LLM_QUERIES["op10_packing"](spark, sf).collect(), table)
    assert len(by_sequence) <= sum(map(len, table.values())) // 1024 + 11


def test_ids_equal_those_of_the_library():
    rng = np.random.default_rng(2)
    letters = list("ab 's\n\t.,1é😀  ßЖ中\r-_'|<>")
    texts = ["".join(rng.choice(letters, rng.integers(0, 80))) for _ in range(600)]
    encoding = encoder(*byte_vocabulary())
    assert [[*encoding.encode(t, allowed_special="all"), 0] for t in texts] == ids_by_library(texts)
