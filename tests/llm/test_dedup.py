"""Exact dedup and line dedup."""

import hashlib
import re

import pytest
from llm_helpers import CLASHES, documents, duck, same_rows

from cellflow.llm.exact_dedup import exact_dedup, keep_one_copy, misra_gries
from cellflow.llm.line_dedup import line_dedup
from cellflow.llm.oracles import LLM_ORACLES
from cellflow.llm.queries import LLM_QUERIES


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op9_line_dedup"])
def test_against_sql(spark, sf, name):
    same_rows(LLM_QUERIES[name](spark, sf), duck(sf), LLM_ORACLES[name])


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min(ids)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out)


@pytest.mark.parametrize("counters", [1, 3, 1000])
def test_exact_cases(spark, counters):
    texts = [None, "", " ", "\n\t", "a  b", "a\nb", "a b ", "x" * 200_000, "x" * 200_000, "é", "a b", *["hot"] * 60]
    docs = documents(spark, texts, extra=CLASHES).repartition(5)
    got = exact_dedup(docs, counters=counters).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_exact(list(enumerate(texts)))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    kept = keep_one_copy(docs, counters=counters)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.keep_id for r in got})


def test_exact_repeated_rows_and_null_ids(spark):
    docs = documents(spark, ["a", "a", "a", "b", "c", "c"], ids=[5, 5, 7, None, None, 3])
    got = exact_dedup(docs).collect()
    assert sum(r.kept for r in got) == 3 and len(got) == 6
    kept = keep_one_copy(docs).collect()
    assert sorted((r.text, r.doc_id) for r in kept if r.doc_id is not None) == [("a", 5), ("c", 3)]
    assert [r.text for r in kept if r.doc_id is None] == ["b"]


def test_exact_empty(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert exact_dedup(docs).count() == 0 and keep_one_copy(docs).count() == 0


def test_heavy_digests_are_found_and_bounded(spark):
    keys = [b"h%d" % (i % 3) for i in range(600)] + [b"u%d" % i for i in range(400)]
    frame = spark.createDataFrame([(bytearray(k),) for k in keys], "digest binary").repartition(4)
    found = {bytes(r[0]): r[1] for r in misra_gries(frame, 20).collect()}
    assert {b"h0", b"h1", b"h2"} <= set(found) and len(found) <= 21
    assert all(v <= 200 for v in found.values())


def test_lines_cases(spark):
    passage = "\n".join(f"a line that repeats {i}" for i in range(40))
    texts = [None, "", "\n", passage, "head\n" + passage + "\ntail", "x\n" * 3, "one line", "é" * 100_000, passage, passage]
    docs = documents(spark, texts, extra=CLASHES)
    got = {r.doc_id: r for r in line_dedup(docs).collect()}
    assert len(got) == len(texts)
    assert got[3].n_removed == 0 and got[3].text == passage
    assert got[4].n_removed >= 30 and got[4].text.startswith("head") and got[4].text.endswith("tail")
    assert got[8].n_removed >= 38 and got[8].text == got[9].text
    assert got[0].text == "" and got[0].n_lines == 1 and got[7].text == texts[7]
    for i, t in enumerate(texts):
        assert got[i].n_lines == len((t or "").split("\n"))


def test_lines_of_empty_table_and_repeated_rows(spark):
    assert line_dedup(documents(spark, ["a"]).limit(0)).count() == 0
    passage = "\n".join(f"line {i}" for i in range(30))
    got = line_dedup(documents(spark, [passage, passage, passage], ids=[1, 1, 2])).collect()
    assert sorted((r.doc_id, r.n_removed > 0) for r in got) == [(1, False), (1, False), (2, True)]
