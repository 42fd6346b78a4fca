"""Ids and texts equal those of the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import CLASHES, documents

from cellflow.llm import pieces
from cellflow.llm.pieces import Encoder, Vocabulary, encode_decode
from cellflow.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


TEXTS = ["", " ", "  a  b ", "a\nb\t c", "▁a ▁", "é😀ﬁ　x\x00 <s> <0x0A>", "x" * 9000, "ab" * 4000, "aaaa" * 700 + "!", "the cat " * 500,
         "ababababababa", "the.\nThe   the", "ÀÀÀÀ", "中文字" * 50, " 1000000000 000"]


def test_encode_equals_the_library(library, monkeypatch):
    rng = random.Random(1)
    letters = list("abcdeth eeinr.\n  é中😀0199_-<>") + ["the", "tion", "ing ", "   ", "aa"]
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    encoder = Encoder(Vocabulary(PATH))
    want = [library.encode(t) for t in texts]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    monkeypatch.setattr(pieces, "REMEMBERED", 60)
    encoder = Encoder(encoder.v)
    got = [x.tolist() for lo in range(0, len(texts), 40) for x in encoder.encode(texts[lo:lo + 40])]
    assert got == want


def test_decode_equals_the_library(library):
    rng = np.random.default_rng(3)
    v = Vocabulary(PATH)
    for _ in range(1500):
        ids = rng.integers(0, 400 if rng.random() < 0.5 else 32000, rng.integers(1, 12)).tolist()
        assert v.decode(ids) == library.decode(ids), ids
    assert all(v.decode(library.encode(t)) == library.decode(library.encode(t)) for t in TEXTS if t)


def test_query_and_cases(spark, sf, library):
    docs = documents(spark, [None, *TEXTS, *TEXTS], extra=CLASHES)
    got = {r.doc_id: (r.ids, r.decoded) for r in encode_decode(docs, PATH).collect()}
    for i, t in enumerate([None, *TEXTS, *TEXTS]):
        ids = library.encode(t or "")
        assert got[i] == (ids, library.decode(ids) if ids else "")
    assert encode_decode(docs.limit(0), PATH).count() == 0
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = LLM_QUERIES["op8_pieces"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
