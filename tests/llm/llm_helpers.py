"""What the tests of this folder share."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def same_rows(frame, con, sql):
    names = sorted(frame.columns)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    order = [columns.index(n) for n in names]
    got = sorted(tuple(str(r[n]) for n in names) for r in frame.collect())
    want = sorted(tuple(str(r[i]) for i in order) for r in result.fetchall())
    assert len(got) == len(want)
    assert got == want


DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, ids=None, lang="en", extra=None):
    """A table like documents; texts may hold None. extra: names of more columns that may clash with helper columns."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, "src0", None if t is None else len(t), *["x"] * len(extra or [])) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOC_SCHEMA + "".join(f", `{e}` string" for e in extra or []))


CLASHES = ["id", "key", "digest", "row", "text_", "_doc", "lines", "count", "start", "number", "hash", "a", "b", "shard", "_key", "_cuts", "_masked", "_text_key", "found", "_id"]
