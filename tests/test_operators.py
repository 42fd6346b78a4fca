import itertools
import math
import pickle
import random
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cellflow.functions import (
    component, dot, entity_id, hashed_entity_id, list_value, literal_of, map_value, record, scaled,
)
from cellflow.operators import folds, versions
from cellflow.operators import paged as paged_module
from cellflow.operators import slices as S
from cellflow.operators.folds import fold_rows
from cellflow.operators.itemsets import capped_counts, filter_by_support, frequent_item_sets, gather_baskets, item_sets
from cellflow.operators.joins import (
    broadcasts, cross_with_row, estimated_bytes, frequent_keys, heavy_keys, is_small, join_with_count, join_with_group_count, key_counts, row_hash, skewed_join,
)
from cellflow.operators.nested import SchemaMismatch, conform, pack, require_type, unpack
from cellflow.operators.paged import first_of_pages, fold_pages, group_pages, last_of_pages, page_stats
from cellflow.operators.versions import latest_versions
from cellflow.session import written
from cellflow.sources.requests import ALL_VERSIONS, ColumnRequest
from cellflow.sources.scan import scan, scan_pages
from tests.helpers import cell_table, cell_view, literal_slice, plan

CELLS = [("c", 4, 0.0), ("b", 3, 3.0), ("b", 2, 0.0), ("a", 1, 1.0), ("a", 0, 0.0)]


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1).select(literal_slice(CELLS).alias("s"), literal_slice([]).alias("e"),
                                 literal_slice([("a", 1, float("nan")), ("a", 0, 2.0)]).alias("n"))


def value(one, column):
    return one.select(column.alias("x")).first().x


def test_orders_and_groups(one):  # X14
    by_q = value(one, S.by_qualifier("s"))
    assert tuple(by_q[0])[:2] == ("a", 1) and tuple(by_q[-1])[:2] == ("c", 4)
    assert [c.version for c in by_q] == [1, 0, 3, 2, 4]
    groups = value(one, S.group_by_qualifier("s"))
    assert {k: len(v) for k, v in groups.items()} == {"a": 2, "b": 2, "c": 1}
    groups = value(one, S.group_cells("s", lambda c: c.value))
    assert {k: [c.version for c in v] for k, v in groups.items()} == {0.0: [4, 2, 0], 3.0: [3], 1.0: [1]}
    assert [c.version for c in value(one, S.chronological("s"))] == [0, 1, 2, 3, 4]
    assert [c.version for c in value(one, S.reverse_chronological(S.chronological("s")))] == [4, 3, 2, 1, 0]
    assert [c.value for c in value(one, S.order_by("s", lambda c: c.value))] == [0, 0, 0, 1, 3]
    assert [c.version for c in value(one, S.order_by("s", lambda c: c.value))] == [4, 2, 0, 1, 3]
    custom = S.order_with("s", lambda a, b: (b.version - a.version).cast("int"))
    assert [c.version for c in value(one, custom)] == [4, 3, 2, 1, 0]


def test_statistics(one):  # X15
    expected = {S.slice_sum: 4, S.slice_sum_squares: 10, S.slice_avg: 0.8, S.slice_variance: 1.36,
                S.slice_stddev: math.sqrt(1.36), S.slice_min: 0, S.slice_max: 3}
    for fn, x in expected.items():
        assert value(one, fn("s")) == pytest.approx(x)
    assert value(one, S.slice_size("s")) == 5
    assert value(one, S.slice_sum("s", lambda c: c.value * 2 + c.version)) == 18
    assert value(one, S.slice_max("s", lambda c: -c.value)) == 0


def test_empty_and_nan(one):
    assert value(one, S.slice_sum("e")) == 0.0
    for fn in (S.slice_avg, S.slice_variance, S.slice_stddev, S.slice_min, S.slice_max):
        assert value(one, fn("e")) is None
    assert value(one, S.slice_min("n")) == 2.0 and value(one, S.slice_max("n")) == 2.0
    assert value(one, S.first_value_or_null("e")) is None
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        value(one, S.first_value("e"))


def test_selectors_equality_fold(one):
    assert value(one, S.first_cell("s")).version == 4 and value(one, S.last_cell("s")).version == 0
    assert value(one, S.values("s")) == [0, 3, 0, 1, 0]
    assert value(one, S.same_slice("s", "s")) and not value(one, S.same_slice("s", "e"))
    joined = S.fold("s", F.lit(""), lambda acc, c: F.concat(acc, c.qualifier))
    assert value(one, joined) == "cbbaa"


def test_long_statistics_agree_with_slices(spark):
    rng = random.Random(7)
    rows = [(f"e{rng.randrange(9)}", f"q{rng.randrange(3)}", v, rng.uniform(-5, 5)) for v in range(400)]
    cells = spark.createDataFrame(rows, "entity string, qualifier string, version bigint, value double")
    long = {r.entity: r for r in S.cell_stats(cells, ["entity"]).collect()}
    gathered = cells.groupBy("entity").agg(F.collect_list(F.struct("qualifier", "version", "value")).alias("s"))
    short = gathered.select("entity", S.slice_size("s").alias("size"), S.slice_sum("s").alias("sum"),
                            S.slice_sum_squares("s").alias("sum_squares"), S.slice_avg("s").alias("avg"),
                            S.slice_variance("s").alias("variance"), S.slice_stddev("s").alias("stddev"),
                            S.slice_min("s").alias("min"), S.slice_max("s").alias("max"))
    for r in short.collect():
        for k, v in r.asDict().items():
            assert long[r.entity][k] == (v if k == "entity" else pytest.approx(v, abs=1e-9)), k


# --- joins ---


def basket_rows(spark):
    items = ["milk", "bread", "coke", "milk", "bread", "butter", "flour", "butter", "flour"]
    return spark.createDataFrame([(i,) for i in items], "item string")


def test_group_count(spark):  # X25
    got = [tuple(r) for r in join_with_group_count(basket_rows(spark), ["item"], "n").collect()]
    assert len(got) == 9 and ("coke", 1) in got and got.count(("milk", 2)) == 2


def test_total_count(spark):  # X26
    got = join_with_count(spark.createDataFrame([("a",), ("b",), ("c",)], "v string"), "n")
    assert [r.n for r in got.collect()] == [3, 3, 3]
    assert "Join" not in plan(got) and "CartesianProduct" not in plan(got)


def test_cross_with_row(spark):
    rows = spark.range(4)
    assert [r.k for r in cross_with_row(rows, spark.range(7, 8).withColumnRenamed("id", "k")).collect()] == [7] * 4
    assert cross_with_row(rows, spark.range(0).withColumnRenamed("id", "k")).count() == 0
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        cross_with_row(rows, spark.range(2).withColumnRenamed("id", "k")).collect()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skewed_join_equals_plain_join(spark, how):
    rng = random.Random(3)
    keys = [None] * 5 + [0] * 700 + [rng.randrange(1, 60) for _ in range(800)]
    left = spark.createDataFrame([(k, i % 5) for i, k in enumerate(keys)], "k int, v int")
    right = spark.createDataFrame([(None, "null")] + [(k, f"r{k}") for k in range(0, 60, 2)], "k int, w string")
    got = skewed_join(left, right, ["k"], how, rows_per_task=100)
    r = right.withColumnRenamed("k", "rk")
    want = left.join(r, left.k.eqNullSafe(r.rk), how).drop("rk")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    counts = key_counts(left, ["k"])
    known = right.join(counts.withColumnRenamed("k", "c"), F.col("k").eqNullSafe(F.col("c"))).drop("c")
    if how in ("inner", "left_semi"):
        told = skewed_join(left, known, ["k"], how, counts, 100, right_knows="_rows").select(got.columns)
        assert sorted(map(str, told.collect())) == sorted(map(str, want.collect()))
    plain = skewed_join(left, right, ["k"], how)  # no heavy key
    assert sorted(map(str, plain.collect())) == sorted(map(str, want.collect()))


def test_heavy_keys(spark):
    rows = spark.createDataFrame([(0,)] * 950 + [(None,)] * 120 + [(i,) for i in range(1, 40)], "k int")
    heavy = heavy_keys(key_counts(rows, ["k"]), ["k"], rows_per_task=100)
    assert {tuple(r) for r in heavy.collect()} == {(0, 10), (None, 2)}
    assert heavy_keys(key_counts(rows, ["k"]), ["k"]).count() == 0
    # Equal rows are spread as well: the hash takes in the partition.
    spread = rows.where("k = 0").repartition(8).select((F.pmod(row_hash(rows), F.lit(10))).alias("part"))
    assert spread.distinct().count() >= 4


def test_frequent_keys(spark):
    rows = spark.createDataFrame([(0, "a")] * 950 + [(None, "a")] * 120 + [(i, "b") for i in range(1, 40)], "k int, s string")
    heavy = {tuple(r) for r in frequent_keys(rows.repartition(4), ["k", "s"], rows_per_task=100).collect()}
    named = rows.distinct().withColumn("h", F.xxhash64("k", "s")).collect()
    assert heavy == {(r.h, 10 if r.k == 0 else 2) for r in named if r.k in (0, None)}
    assert frequent_keys(rows, ["k"]).count() == 0 and frequent_keys(rows.limit(0), ["k"], 1).count() == 0
    text = plan(frequent_keys(rows, ["k", "s"]))
    assert text.count("Exchange") == 1 and "SinglePartition" in text  # summaries of tasks, no keys
    with pytest.raises(ValueError):
        skewed_join(rows, rows, ["k"], right_knows="_rows")


def test_size_known_before_a_job(spark, sf):
    nation, lines = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("nation", "lineitem"))
    assert 0 < estimated_bytes(nation.select("n_nationkey")) < estimated_bytes(lines)
    assert broadcasts(nation) and broadcasts(nation.groupBy("n_regionkey").count())
    for setting, says in (("-1", False), ("1k", False), ("100m", True)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        assert broadcasts(lines) is says
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_is_small(spark):
    assert is_small(spark.range(10)) and not is_small(spark.range(10), max_rows=9)
    assert not is_small(spark.range(100), max_bytes=10) and is_small(spark.range(0))


# --- newest versions ---


def brute_newest(rows, n):
    cells = {}
    for key, version, value, order in rows:
        mine = cells.setdefault(key, {})
        if version not in mine or mine[version][0] < order:
            mine[version] = (order, value)
    return sorted(str((key, v, mine[v][1])) for key, mine in cells.items() for v in sorted(mine, reverse=True)[:n])


@pytest.mark.parametrize("n", [2, 3, 50])
@pytest.mark.parametrize("held", [10, 200_000])
def test_newest_versions_with_rewrites(spark, monkeypatch, n, held):
    monkeypatch.setattr(versions, "STATE_ROWS", held)
    rng = random.Random(n)
    rows = [((rng.choice([None, "a", "é", "b"]), rng.randrange(6)), rng.randrange(20), f"v{i}", i) for i in range(1500)]
    rows += [(("hot", 0), 7, f"w{i}", 10_000 + i) for i in range(3000)]  # one cell, written again and again
    frame = spark.createDataFrame([(*k, v, x, o) for k, v, x, o in rows], "k string, q int, version bigint, value string, seq bigint").repartition(3)
    for order in (F.col("seq"), F.struct(F.col("seq"), "value"), F.struct(F.array("seq"))):  # the last is not held in a task's state
        got = latest_versions(frame.withColumn("_order", order), ["k", "q"], n, "_order", ["k"])
        assert sorted(str(((r.k, r.q), r.version, r.value)) for r in got.collect()) == brute_newest(rows, n)


def test_order_of_a_task_is_that_of_spark(spark):
    nan, inf = float("nan"), float("inf")
    numbers = [None, nan, inf, -inf, 0.0, -0.0, 1.5, -1.5, 1e300]
    rows = [(x, y, s, x is not None, Decimal(i)) for i, (x, y, s) in enumerate(
        (x, y, s) for x in numbers for y in numbers for s in (None, "", "z", "é", "Z"))]
    frame = spark.createDataFrame(rows, "x double, y float, s string, b boolean, d decimal(9,2)").select(
        F.struct("x", "y", "b", "d", "s", F.when(F.col("b"), F.date_add(F.lit("2020-01-01"), F.length("s"))).alias("t")).alias("o"))
    # All rows are rewrites of one cell, so the last write is the greatest by Spark's own order.
    cells = frame.select(F.lit(1).alias("k"), F.lit(1).alias("version"), F.to_json("o").alias("value"), F.col("o").alias("_order"))
    assert latest_versions(cells, ["k"], 2, "_order").first().value == cells.agg(F.max_by("value", "_order")).first()[0]
    for low in range(0, len(rows), 40):
        some = spark.createDataFrame(cells.orderBy(F.col("_order")).collect()[:low + 1], cells.schema)
        assert latest_versions(some, ["k"], 2, "_order").first().value == some.agg(F.max_by("value", "_order")).first()[0]


def test_rewrites_combine_in_the_task():
    n = 1_000_000
    table = pa.table({"k": pa.array(np.zeros(n, np.int64)), "version": pa.array(np.full(n, 5)), "value": pa.array(np.arange(n)), "o": pa.array(np.arange(n))})
    kept = versions.newest_rows(table, ["k"], "o", 3).to_pylist()
    assert kept == [{"k": 0, "version": 5, "value": n - 1, "o": n - 1}]


# --- slices page by page ---


@pytest.fixture(scope="module")
def paged(spark):
    """Pages of slices of 1, 7 and 900 cells, and the slices themselves."""
    rng = random.Random(12)
    rows = [(e, q, v, rng.choice([1e9, 0.5, -3.0]) + v / 7) for e, n in (("one", 1), ("few", 7), ("hot", 900)) for q, v in
            sorted({(rng.choice("abc"), rng.randrange(2000)) for _ in range(n)})]
    table = cell_table(cell_view(spark, "m", rows, "double"))
    request = ColumnRequest("m", max_versions=ALL_VERSIONS)
    return written(scan_pages(table, request, page_size=5), "pages"), {r.entity: r.s for r in scan(table, {"s": request}).collect()}


def test_first_last_and_statistics_of_pages(paged):
    pages, whole = paged
    assert {r.entity: r.first for r in first_of_pages(pages, ["entity"]).collect()} == {e: s[0] for e, s in whole.items()}
    assert {r.entity: r.last for r in last_of_pages(pages, ["entity"]).collect()} == {e: s[-1] for e, s in whole.items()}
    for r in page_stats(pages, ["entity"]).collect():
        values = [c.value for c in whole[r.entity]]
        assert (r.n, r.min, r.max) == (len(values), min(values), max(values))
        assert math.isclose(r.sum, sum(values), rel_tol=1e-12) and math.isclose(r["mean"], sum(values) / len(values), rel_tol=1e-12)
        assert math.isclose(r.variance, float(np.var(values)), rel_tol=1e-9, abs_tol=1e-6)


def test_groups_of_pages(paged):
    pages, whole = paged
    got = {}
    for r in group_pages(pages, ["entity"]).orderBy("page").collect():
        assert 1 <= len(r.cells) <= 5 and r.page == len(got.setdefault((r.entity, r.qualifier), []))
        got[r.entity, r.qualifier].append(r.cells)
    want = {(e, q): [c for c in s if c.qualifier == q] for e, s in whole.items() for q in {c.qualifier for c in s}}
    assert {k: [c for piece in v for c in piece] for k, v in got.items()} == want


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_ordered_fold_of_pages(paged, monkeypatch, fan):
    monkeypatch.setattr(paged_module, "FAN", fan)
    pages, whole = paged
    text = lambda cells: F.array_join(F.transform(cells, lambda c: F.concat(c.qualifier, c.version.cast("string"))), " ")
    folded = fold_pages(pages, ["entity"], text, lambda a, b: F.concat_ws(" ", a, b), "all", F.upper)
    assert {r.entity: r["all"] for r in folded.collect()} == {e: " ".join(f"{c.qualifier}{c.version}" for c in s).upper() for e, s in whole.items()}
    assert fold_pages(pages.limit(0), ["entity"], text, lambda a, b: a, "all").count() == 0


def test_states_are_merged_in_a_tree(spark, monkeypatch):
    states = spark.range(0, 300, 1, 300).select(F.lit(pickle.dumps([1])).alias("state"))
    monkeypatch.setattr(folds, "FAN", 8)
    left = folds.merged_states(states, lambda a, b: [a[0] + b[0]])
    assert 1 <= left.count() <= 8
    assert sum(pickle.loads(bytes(r.state))[0] for r in left.collect()) == 300
    total = fold_rows(spark.range(0, 100, 1, 100), ["id"], lambda: 0, lambda s, b: s + int(b["id"].sum()), lambda a, b: a + b, float, "total")
    assert total.first().total == 4950.0
    assert fold_rows(spark.range(0), ["id"], lambda: 0, lambda s, b: s + 1, lambda a, b: a + b, float, "total").first().total == 0.0


# --- item sets ---

BASKETS = [["milk", "bread", "coke"], ["milk", "bread", "butter", "flour"], ["butter", "flour"]]


def baskets(spark, rows=BASKETS, t="string"):
    return spark.createDataFrame([(b,) for b in rows], f"basket array<{t}>")


def subsets(basket, lo, hi):
    ordered = sorted(basket)
    return [s for k in range(lo, hi + 1) for s in set(itertools.combinations(ordered, k))]


def test_item_pairs(spark):  # X24
    got = [r.s for r in item_sets(baskets(spark), "basket", "s", 2, 2).collect()]
    assert len(got) == 10 and got.count("bread,milk") == 2 and got.count("butter,flour") == 2
    assert len(set(got)) == 8


def test_item_sets_against_brute_force(spark):
    rng = random.Random(11)
    rows = [[rng.randrange(8) for _ in range(rng.randrange(0, 9))] for _ in range(60)]
    for lo, hi in ((1, 1), (2, 2), (2, 4), (1, 5), (3, 3)):
        for split in (None, 4):
            sets = item_sets(baskets(spark, rows, "int"), "basket", "s", lo, hi, split_above=split)
            assert sorted(r.s for r in sets.collect()) == sorted(",".join(map(str, s)) for b in rows for s in subsets(b, lo, hi))
    with pytest.raises(ValueError):
        item_sets(baskets(spark), "basket", "s", 3, 2)


def test_item_sets_do_not_shuffle(spark):
    assert "Exchange" not in plan(item_sets(baskets(spark), "basket", "s", 2, 5, split_above=None))


def test_support(spark):  # X27
    pairs = item_sets(baskets(spark), "basket", "s", 2, 2)
    want = {("bread,milk", 2, 3.0, 2 / 3), ("butter,flour", 2, 3.0, 2 / 3)}
    assert {tuple(r) for r in filter_by_support(pairs, "s", "support", 0.5, constant=3.0).collect()} == want
    count = baskets(spark).agg(F.count("*").alias("normalizer"))
    assert {tuple(r) for r in filter_by_support(pairs, "s", "support", 0.5, normalizer=count).collect()} == want
    assert filter_by_support(pairs, "s", "support", 2 / 3, constant=3.0).count() == 0
    with pytest.raises(ValueError):
        filter_by_support(pairs, "s", "support", 0.5)
    with pytest.raises(ValueError):
        filter_by_support(pairs, "s", "support", 0.5, constant=3.0, normalizer=count)


def test_frequent_item_sets_against_brute_force(spark):
    rng = random.Random(5)
    data = {b: [min(int(rng.expovariate(0.4)), 12) for _ in range(rng.randrange(1, 9))] for b in range(80)}
    rows = spark.createDataFrame([(b, i) for b, items in data.items() for i in items], "b int, i int")
    for threshold in (0.05, 0.2, 0.0):
        counts = {}
        for items in data.values():
            for s in subsets(items, 2, 4):
                counts[s] = counts.get(s, 0) + 1
        want = {(",".join(map(str, s)), n, round(n / 80, 9)) for s, n in counts.items() if n / 80 > threshold}
        got = frequent_item_sets(rows, ["b"], "i", threshold, 2, 4).collect()
        assert {(r[0], r[1], round(r[2], 9)) for r in got} == want


def test_a_large_basket_emits_candidates_only(spark):
    rows = [(0, i) for i in range(300)] + [(b, i) for b in range(1, 40) for i in (1, 2, 3)] + [(b, b % 300) for b in range(40, 700)]
    got = frequent_item_sets(spark.createDataFrame(rows, "b int, i int"), ["b"], "i", 0.01, 2, 5).collect()
    assert {(r[0], r[1]) for r in got} == {("1,2", 40), ("1,3", 40), ("2,3", 40), ("1,2,3", 40)}


def test_gathered_baskets_are_bounded(spark):
    rows = spark.createDataFrame([(1, "a")] * 50 + [(1, "b")], "b int, i string")
    got = gather_baskets(capped_counts(rows, ["b"], "i", 3), ["b"], "i", "items").first()
    assert sorted(got["items"]) == ["a", "a", "a", "b"]


# --- folds ---


def test_user_fold(spark):  # X38
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 5.0), (7.0, 3.0)], "a double, b double").repartition(3)
    got = fold_rows(rows, ["a", "b"], lambda: (0.0, 0), lambda s, b: (s[0] + (b.a - b.b).abs().sum(), s[1] + len(b)),
                    lambda x, y: (x[0] + y[0], x[1] + y[1]), lambda s: s[0] / max(s[1], 1), "mean")
    assert got.collect() == [(7 / 3,)]
    empty = rows.where("a > 100")
    got = fold_rows(empty, ["a"], lambda: 0.0, lambda s, b: s + b.a.sum(), lambda x, y: x + y, lambda s: s, "t", "double")
    assert got.collect() == [(0.0,)]


# --- shaping ---


def test_pack_unpack(spark):  # X16, X17
    rows = spark.createDataFrame([("1 eid1 word1", 12)], "line string, length int")
    packed = pack(rows, ["line", "length"], "rec")
    assert packed.columns == ["line", "length", "rec"] and packed.first().rec.asDict() == {"line": "1 eid1 word1", "length": 12}
    out = unpack(packed, "rec", ["x", "y"])
    assert out.select("x", "y").first() == ("1 eid1 word1", 12)
    assert unpack(packed.select("rec"), "rec", ["length"], by_name=True).first().length == 12
    with pytest.raises(SchemaMismatch):
        unpack(packed, "rec", ["x"])
    with pytest.raises(SchemaMismatch):
        unpack(packed, "length", ["x"])


def test_conform(spark):  # X19-X21
    rows = spark.createDataFrame([(("a", 1, 2.0), [("x", 1)], {"k": ("y", 2)}, None)],
                                 "r struct<s:string,i:int,d:double>, l array<struct<s:string,i:int>>, "
                                 "m map<string,struct<s:string,i:int>>, z void")
    dtype = {f.name: f.dataType for f in rows.schema.fields}

    def to(column, ddl):
        return conform(column, dtype[column], DataType.fromDDL(ddl), column)

    got = rows.select(to("r", "struct<d:double,s:string>").alias("r"), to("l", "array<struct<i:int>>").alias("l"),
                      to("m", "map<string,struct<s:string>>").alias("m"), to("z", "int").alias("z")).first()
    assert got.r.asDict() == {"d": 2.0, "s": "a"} and got.l[0].asDict() == {"i": 1}
    assert got.m["k"].asDict() == {"s": "y"} and got.z is None
    for bad in (("r", "struct<nope:int>"), ("r", "struct<i:bigint>"), ("r", "string"), ("l", "array<int>")):
        with pytest.raises(SchemaMismatch):
            to(*bad)


def test_strict_reads(spark):
    rows = spark.createDataFrame([(1, {"a": 1}, [5, 6])], "n int, m map<string,int>, l array<int>")
    assert rows.select(require_type(rows, "n", "int"), map_value("m", "a"), list_value("l", 1)).first() == (1, 1, 6)
    with pytest.raises(SchemaMismatch):
        require_type(rows, "n", "bigint")
    for bad in (map_value("m", "zz"), list_value("l", 2), list_value("l", -1)):
        with pytest.raises(Exception, match="USER_RAISED"):
            rows.select(bad).collect()


def test_vectors(spark):
    rows = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0])], "a array<double>, b array<double>")
    assert rows.select(dot("a", "b"), scaled("a", F.lit(2))).first() == (11.0, [2.0, 4.0])


# --- entity ids ---


def test_entity_order(spark):  # X12
    rows = spark.createDataFrame([("test", 3, None), ("test", 2, 1), ("test", 2, None), ("sest", 9, 9)], "a string, b int, c int")
    got = rows.orderBy(entity_id("a", "b", "c")).collect()
    assert [tuple(r) for r in got] == [("sest", 9, 9), ("test", 2, None), ("test", 2, 1), ("test", 3, None)]


def test_entity_joins(spark):  # X11
    left = spark.createDataFrame([("0row", 1), ("1row", 2), ("2row", 3)], "k string, v int")
    right = spark.createDataFrame([("0row",), ("2row",)], "k string")
    for make in (lambda: entity_id("k"), lambda: hashed_entity_id("k")):
        a, b = left.select(make().alias("entityId"), "v"), right.select(make().alias("entityId"))
        assert sorted(r.v for r in a.join(b, "entityId").collect()) == [1, 3]
    assert left.select(component(entity_id("k", "v"), 1).alias("c")).first().c == 1
    with pytest.raises(Exception, match="DATATYPE_MISMATCH"):
        left.select(entity_id("k") == entity_id("v")).select("nope")
    assert left.select(record(a="k", b=F.lit(1)).alias("r")).first().r.asDict() == {"a": "0row", "b": 1}


def test_typed_literals(spark):
    t = DataType.fromDDL("struct<a:int,l:array<string>,m:map<string,bigint>,s:struct<x:double>>")
    for v in ((1, ["p"], {"k": 2}, (3.5,)), {"a": 1, "l": ["p"], "m": {"k": 2}, "s": {"x": 3.5}}):
        got = spark.range(1).select(literal_of(v, t).alias("v"))
        assert got.schema["v"].dataType.simpleString() == t.simpleString()
        assert got.first().v.asDict(True) == {"a": 1, "l": ["p"], "m": {"k": 2}, "s": {"x": 3.5}}
    assert spark.range(1).select(literal_of((None, [], {}, None), t).alias("v")).first().v.asDict() == {"a": None, "l": [], "m": {}, "s": None}


def test_hashed_ids_of_different_ids_differ(spark):
    frame = spark.createDataFrame([("a\x00b", None)], "x string, y string")
    ids = frame.select(
        hashed_entity_id("x"), hashed_entity_id(F.lit("a"), F.lit("b")), hashed_entity_id("x", "y"), hashed_entity_id("y", "x"),
        hashed_entity_id(F.lit("\x01")), hashed_entity_id("y"), hashed_entity_id(F.lit("n")), hashed_entity_id(F.lit("1:a1:b"))).first()
    assert len({bytes(i) for i in ids}) == 8
