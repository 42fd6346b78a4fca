"""The pipeline against brute force, stage by stage, and the entry's names."""

import re

import corpus_pipeline
from llm_helpers import CLASHES, documents
from test_jaccard import brute
from test_packing import check, ids_by_library

from __spark_entry__ import oracle_sql, queries


def test_names():
    names = queries()
    assert [n for k in range(1, 11) for n in names if n.startswith(f"op{k}_")] == sorted(
        (n for n in names if re.match(r"op\d+_", n)), key=lambda n: int(n[2:].split("_")[0]))
    assert "pipeline" in names and set(oracle_sql()) <= set(names)


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.language(spark, docs, sf)
    assert kept.columns == docs.columns and kept.where(r"NOT text RLIKE '\\p{L}'").count() == 0 and kept.count() >= 0.98 * docs.count()
    rows = {r.doc_id: r for r in kept.collect()}
    exact = corpus_pipeline.exact_copies(spark, kept, sf)
    first = {}
    for i in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i].text), i)
    assert {r.doc_id for r in exact.collect()} == set(first.values())
    near = corpus_pipeline.near_copies(spark, exact, sf)
    component, _ = brute([(i, rows[i].text) for i in sorted(first.values())])
    assert {r.doc_id for r in near.collect()} == {i for i, c in component.items() if i == c}
    masked = {r.doc_id: r for r in corpus_pipeline.personal_data(spark, near, sf).collect()}
    assert not any(re.search(r"[0-9]@mail|\+1 \([0-9]", r.text) for r in masked.values())
    same = [i for i in masked if masked[i].text == rows[i].text]
    assert len(same) > 0.8 * len(masked) and all(r.n_chars == len(r.text) for r in masked.values())
    table = spark.createDataFrame(list(masked.values()), docs.schema)
    pieces = corpus_pipeline.packing(spark, table, sf).collect()
    check(pieces, dict(zip(masked, ids_by_library([r.text for r in masked.values()]))))


def test_run_on_odd_rows(spark, tmp_path):
    texts = [None, "", "12 34", "the house is red " * 9, "the house is red " * 9, "call +1 (974) 555-3436 about the house", "the house is red " * 8]
    for name, table in (("some", documents(spark, texts, extra=CLASHES)), ("none", documents(spark, texts).limit(0))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    assert {r.doc_id for r in pieces} <= {3, 5, 6} and {3, 5} <= {r.doc_id for r in pieces}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
