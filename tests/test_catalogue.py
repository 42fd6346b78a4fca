"""Every catalogue query against DuckDB on the same files."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from cellflow.plans.catalogue import QUERIES
from cellflow.plans.oracles import ORACLES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    return str(v)


def compare(frame, con, sql):
    names = sorted(frame.columns)
    got = sorted([normal(r[n]) for n in names] for r in frame.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    order = [columns.index(n) for n in names]
    want = sorted([normal(r[i]) for i in order] for r in result.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    compare(QUERIES[name](spark, sf), duck, ORACLES[name])


def test_entry(spark):
    assert entry(spark).count() == 5
