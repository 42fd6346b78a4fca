import os
import random
import re
import tempfile
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cellflow.functions import random_entity_id, words
from cellflow.operators.slices import first_value
from cellflow.plans import catalogue
from cellflow.plans.catalogue import QUERIES
from cellflow.plans.oracles import ORACLES
from cellflow.session import shared_folder
from cellflow.sources.cell_log import CellColumns, CellLog, ColumnLayout, ColumnOutput, InvalidWrite, write_outputs
from cellflow.sources.files import (
    ParquetFile, SequencePairs, TextFile, TsvFile, text_lines, write_sequence_file, write_text, write_tsv,
)
from cellflow.sources.cells import CellTable, WideCells
from cellflow.sources.requests import ALL_VERSIONS, ColumnRequest, TimeRange
from cellflow.sources.scan import scan_cells
from cellflow.sources.side_data import (
    contains_key, delimited_text, key_values, lookup, records, table_column,
)
from tests.helpers import cell_table, cell_view, plan, slices

REC = "struct<contained_string:string,field2:string,field3:int>"
LAYOUT = {"family:column1": "string", "family:column2": "string", "family:size": "int", "searches": "int",
          "family:narrow": "struct<contained_string:string>", "family:any": ColumnLayout(),
          "family:validated": ColumnLayout(validated=True)}


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def log(spark, path):
    return CellLog(spark, path, {"entity": "string"}, LAYOUT).create()


def test_words_in_time_order(spark, log):  # X6
    lines = spark.createDataFrame([("1 eid1 word1",), ("3 eid1 word2",), ("5 eid2 word3",), ("7 eid2 word4",)], "line string")
    rows = lines.select(words("line").alias("w")).selectExpr("w[0] as timestamp", "w[1] as entity", "w[2] as word")
    log.write(rows, {"word": "family:column1"}, version="timestamp")
    got = slices(log.scan({"w": ColumnRequest("family:column1", max_versions=ALL_VERSIONS)}), "w")
    assert {e: [c[2] for c in s] for e, s in got.items()} == {"eid1": ["word2", "word1"], "eid2": ["word4", "word3"]}


def test_map_family(spark, log):  # X8
    rows = spark.createDataFrame([("me", "dogs", 4), ("me", "cats", 5), ("me", "fish", 3)], "entity string, word string, n int")
    log.write(rows, {"n": ColumnOutput("searches", qualifier_field="word")})
    got = slices(log.scan({"s": "searches"}), "s")
    assert {c[0]: c[2] for c in got["me"]} == {"dogs": 4, "cats": 5, "fish": 3} and len(got) == 1
    assert len({c[1] for c in got["me"]}) == 1 and got["me"][0][1] > 1_600_000_000_000


def test_upsert_and_several_columns(spark, log):
    first = spark.createDataFrame([("a", "x", 1, 7), ("b", "y", 2, 7)], "entity string, w string, n int, ts int")
    outputs = {"w": "family:column1", "n": "family:size"}
    log.write(first, outputs, version="ts")
    log.write(first.limit(1).withColumn("w", F.lit("later")), outputs, version="ts")
    twice = spark.createDataFrame([("b", "p", 5, 8, 1), ("b", "q", 6, 8, 2)], "entity string, w string, n int, ts int, o bigint")
    log.write(twice, outputs, version="ts", order_by="o")
    got = log.scan({"w": ColumnRequest("family:column1", max_versions=9), "n": "family:size"})
    assert slices(got, "w") == {"a": [("column1", 7, "later")], "b": [("column1", 8, "q"), ("column1", 7, "y")]}
    assert {r.entity: r.n for r in got.select("entity", first_value("n").alias("n")).collect()} == {"a": 1, "b": 6}


def test_same_cell_twice_in_a_write(spark, log):
    rows = spark.createDataFrame([("a", f"w{i}") for i in range(9)], "entity string, w string").repartition(4)
    log.write(rows, {"w": "family:column1"}, version=F.lit(1))
    for n in (1, 2, None):
        got = slices(log.scan({"w": ColumnRequest("family:column1", max_versions=n)}), "w")
        assert got == {"a": [("column1", 1, "w8")]}


def test_read_prunes_partitions_and_values(spark, log):
    rows = spark.createDataFrame([("a", "x", 1)], "entity string, w string, n int")
    log.write(rows, {"w": "family:column1", "n": "family:size"}, version=F.lit(1))
    text = plan(scan_cells(log.table(), "family:size"))
    assert "PartitionFilters: [" in text and "column1" not in text.split("PartitionFilters")[1].split("]")[0]
    assert "ReadSchema: struct<entity:string,version:bigint,batch:bigint,seq:bigint,value_int:int>" in text


def test_layout_can_grow(spark, log, path):
    log.write(spark.createDataFrame([("a", "x", 3)], "entity string, w string, n int"), {"w": "family:column1", "n": "family:size"})
    grown = CellLog(spark, path, {"entity": "string"}, {**LAYOUT, "family:flag": "boolean", "family:nested": "array<int>"})
    grown.write(spark.createDataFrame([("a", True, [1])], "entity string, f boolean, l array<int>"), {"f": "family:flag", "l": "family:nested"})
    fields = {"w": "family:column1", "n": "family:size", "f": "family:flag", "l": "family:nested"}
    got = grown.scan(fields).select(*[first_value(f).alias(f) for f in fields]).collect()
    assert [tuple(r) for r in got] == [("x", 3, True, [1])]


def test_one_job_writes_all_declared_columns(spark, log, path):
    rows = spark.createDataFrame([("a", "x", 1)], "entity string, w string, n int").coalesce(1)
    log.write(rows, {"w": "family:column1", "n": "family:size"}, version=F.lit(1))
    assert sorted(d for d in os.listdir(f"{path}/cells") if d.startswith("column")) == \
        ["column=family%3Acolumn1", "column=family%3Asize"]


def test_writer_schemas(spark, log):  # X19-X21
    rows = spark.createDataFrame([("a", ("s", "t", 3))], f"entity string, r {REC}")
    log.write(rows, {"r": "family:narrow"})
    assert log.scan({"r": "family:narrow"}).select(first_value("r")).first()[0].asDict() == {"contained_string": "s"}
    log.write(rows, {"r": ColumnOutput("family:any", schema="struct<contained_string:string,field2:string>")}, version=F.lit(1))
    assert log.scan({"r": "family:any"}).select(first_value("r")).first()[0].asDict() == {"contained_string": "s", "field2": "t"}
    log.write(rows, {"r": "family:any"}, version=F.lit(2))
    got = slices(log.scan({"r": ColumnRequest("family:any", max_versions=2)}), "r")["a"]
    assert [c[2].asDict() for c in got] == [{"contained_string": "s", "field2": "t", "field3": 3},
                                            {"contained_string": "s", "field2": "t", "field3": None}]
    with pytest.raises(InvalidWrite, match="family:validated"):
        log.write(rows, {"r": "family:validated"})
    log.write(rows, {"r": ColumnOutput("family:validated", schema=REC)})
    assert log.scan({"r": "family:validated"}).count() == 1


def test_bad_writes_name_every_fault(spark, log):
    rows = spark.createDataFrame([(1, "x")], "id int, w string")
    with pytest.raises(InvalidWrite) as e:
        log.write(rows, {"w": "family:size", "nope": "family:column1", "id": "other:x"})
    for part in ("entity", "family:size", "nope", "other:x"):
        assert part in str(e.value)
    ok = spark.createDataFrame([("a", 2**40)], "entity string, n bigint")
    with pytest.raises(InvalidWrite, match="bigint"):  # never narrowed or widened
        log.write(ok, {"n": "family:size"})


def test_nulls_and_empty_collections(spark, path):  # X22
    log = CellLog(spark, path, {"entity": "string"}, {"f:r": "struct<n:string,l:array<int>,m:map<string,int>>", "f:s": "string"}).create()
    rows = spark.createDataFrame([("a", (None, [], {}), None)], "entity string, r struct<n:string,l:array<int>,m:map<string,int>>, s string")
    log.write(rows, {"r": "f:r", "s": "f:s"})
    got = log.scan({"r": "f:r", "s": "f:s"}).select(first_value("r").alias("r"), first_value("s").alias("s")).first()
    assert got.r.n is None and got.r.l == [] and got.r.m == {} and got.s is None


def test_import_with_random_ids(spark, log, path):  # X7, C11
    with open(f"{path}.txt", "w") as f:
        f.write("hello hello hello world world hello\nworld hello   world      hello\n")
    lines = text_lines(spark, f"{path}.txt")
    rows = lines.select(F.explode(words("line")).alias("word")).withColumn("entity", random_entity_id())
    log.write(rows, {"word": "family:column1"})
    got = log.scan({"w": "family:column1"}).groupBy(first_value("w").alias("w")).count().collect()
    assert {r.w: r["count"] for r in got} == {"hello": 6, "world": 4}


# --- files ---


def test_text_with_offsets(spark, path):  # X40
    write_text(spark.createDataFrame([("a", 1), ("b", None)], "k string, v int").coalesce(1), f"{path}/t")
    assert [r.line for r in text_lines(spark, f"{path}/t").collect()] == ["a\t1", "b\tnull"]
    assert [tuple(r) for r in text_lines(spark, f"{path}/t", offsets=True).collect()] == [(0, "a\t1"), (4, "b\tnull")]


def test_text_round_trip_has_the_place_of_every_line(spark, path, monkeypatch):
    """The result equals the SQL, which has the place, and a line that is not where its file has it is not placed."""
    people = [(i, name, i % 3) for i, name in enumerate(["a", "é漢", "", "a b", "Customer"] * 40)]
    people += people[:25]
    rows = spark.createDataFrame(people, "c_custkey bigint, c_name string, c_nationkey int")
    rows.repartition(3).write.parquet(f"{path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{path}/customer.parquet/*.parquet'")
    result = con.execute(ORACLES["text_round_trip"])
    assert [d[0] for d in result.description] == ["custkey", "name", "nation", "placed"]
    got = QUERIES["text_round_trip"](spark, path)
    assert got.columns == ["custkey", "name", "nation", "placed"]
    assert sorted(map(tuple, got.collect())) == sorted(result.fetchall()) == sorted((*p, True) for p in people)

    right = catalogue.placed_lines

    def moved(change):
        monkeypatch.setattr(catalogue, "placed_lines", lambda *a: right(*a).withColumn("offset", change))
        return QUERIES["text_round_trip"](spark, path).groupBy("placed").count().collect()

    assert dict(moved(F.col("offset") + 7)) == {True: 222, False: 3}  # only where the three files begin
    assert dict(moved(F.lit(0).cast("bigint"))) == {False: 225}


def test_tsv_and_sequence_files(spark, path):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    write_tsv(rows.coalesce(1), f"{path}/tsv")
    assert sorted(tuple(r) for r in TsvFile(f"{path}/tsv", "k string, v int").read(spark).collect()) == [("a", 1), ("b", 2)]
    write_sequence_file(rows, f"{path}/seq")
    got = SequencePairs(f"{path}/seq", fields=("x", "y")).read(spark)
    assert got.columns == ["x", "y"] and sorted(tuple(r) for r in got.collect()) == [("a", "1"), ("b", "2")]
    with pytest.raises(ValueError):
        SequencePairs(f"{path}/seq", fields=("x",))
    with pytest.raises(ValueError):
        write_sequence_file(rows.withColumn("z", F.lit(1)), f"{path}/seq3")


def test_several_outputs(spark, path, log):  # K13
    rows = spark.createDataFrame([("a", "x")], "entity string, w string")
    sinks = {"cells": CellColumns(log, {"w": "family:column1"}), "text": TextFile(f"{path}/text"),
             "table": ParquetFile(f"{path}/table")}
    write_outputs({"cells": rows, "text": rows, "table": rows}, sinks)
    assert sinks["cells"].read(spark).count() == 1 and sinks["table"].read(spark).first().w == "x"
    assert sinks["text"].read(spark).first().line == "a\tx"
    with pytest.raises(InvalidWrite):
        write_outputs({"other": rows}, sinks)


# --- side data ---


def test_side_data_sources(spark, path):  # X39
    kv = spark.createDataFrame([(1, "blah", "one"), (2, "blah", "two"), (2, "blah", "deux")], "key int, blah string, value string")
    kv.withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{path}/kv")
    side = key_values(spark, f"{path}/kv")
    assert side.columns == ["key", "value"]
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception, match="repeats the key"):
        lookup(rows, side, "k", "v").collect()
    ordered = spark.read.parquet(f"{path}/kv").select("key", "value", "at")
    assert {tuple(r) for r in lookup(rows, ordered, "k", "v", keep_first_by="at").collect()} == {(1, "one"), (2, "two")}

    recs = spark.createDataFrame([((1,), "blah", "one"), ((2,), "b", "two")], "key struct<innerkey:int>, blah string, value string")
    recs.write.parquet(f"{path}/rec")
    by_record = records(spark, f"{path}/rec", "key")
    got = lookup(rows.select(F.struct(F.col("k").alias("innerkey")).alias("k")), by_record, "k", "v").collect()
    assert sorted(r.v.value for r in got) == ["one", "two"]

    with open(f"{path}.txt", "w") as f:
        f.write("key1,value1\nkey2,value2,more\nbare\n")
    assert {tuple(r) for r in delimited_text(spark, f"{path}.txt", ",").collect()} == \
        {("key1", "value1"), ("key2", "value2,more"), ("bare", None)}

    table = cell_table(cell_view(spark, "family", [("e1", "c", 1, "old"), ("e1", "c", 2, "new")], qualifiers=["c"]))
    assert [tuple(r) for r in table_column(table, "family:c").collect()] == [("e1", "new")]


@pytest.mark.parametrize("small", [None, True, False])
def test_lookup_rules(spark, small):
    side = spark.createDataFrame([(1, "one"), (2, None)], "key int, value string")
    rows = spark.createDataFrame([(1,)] * 30 + [(2,), (3,)], "k int")
    got = lookup(rows, side, "k", "v", on_missing="null", small=small)
    assert got.columns == ["k", "v"]
    want = [(1, "one")] * 30 + [(2, None), (3, None)]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want))
    with pytest.raises(Exception, match="side data has no key"):
        lookup(rows, side, "k", "v", small=small).collect()
    with pytest.raises(Exception, match="key is null"):
        lookup(rows.withColumn("k", F.lit(None).cast("int")), side, "k", "v", small=small).collect()
    got = contains_key(rows.distinct(), side, "k", "has", small=small).collect()
    assert {tuple(r) for r in got} == {(1, True), (2, True), (3, False)}


def test_lookup_by_composite_id_without_broadcast(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 2, "z")], "k string, n int, v string")
    wide = CellTable(["k", "n"], [WideCells(frame, "f", {"k": "k", "n": "n"}, {"v": "v"})])
    rows = frame.select("k", "n", F.struct("k", "n").alias("eid"))
    got = lookup(rows, table_column(wide, "f:v"), "eid", "found", small=False)
    assert {(r.k, r.n, r.found) for r in got.collect()} == {("a", 1, "x"), ("a", None, "y"), ("b", 2, "z")}


@pytest.mark.parametrize("size", ["40b", "1k", "1g"])
def test_offsets_of_lines_in_blocks(spark, path, size):
    """Files are split into blocks of any size, and lines end in every way."""
    rng = random.Random(9)
    want = []
    os.makedirs(path, exist_ok=True)
    for name in ("a.txt", "b.txt", "empty.txt"):
        data, n = b"", {"a.txt": 120, "b.txt": 40, "empty.txt": 0}[name]
        for i in range(n):
            line = "".join(rng.choice(["x", "é", "漢", " ", "\t"]) for _ in range(rng.choice([0, 1, 5, 30, 90])))
            want.append((len(data), line))
            data += line.encode() + (b"" if i == n - 1 and line else rng.choice([b"\n", b"\r\n", b"\n"] if name == "a.txt" else [b"\n", b"\r"]))
            if data.endswith(b"\r") and name == "b.txt":
                data += b"z\n"  # a line feed after a carriage return would belong to it
                want.append((len(data) - 2, "z"))
        with open(f"{path}/{name}", "wb") as out:
            out.write(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = text_lines(spark, path, offsets=True)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "Python" not in plan(got) and got.columns == ["offset", "line"]


def test_random_writes_against_a_dictionary(spark, path):
    rng = random.Random(23)
    log = CellLog(spark, path, {"entity": "string"}, {"m": "int", "g:a": "int", "g:b": "int"}).create()
    cells = {}
    for batch in range(3):
        rows = [(f"e{rng.randrange(4)}", f"q{rng.randrange(3)}", rng.randrange(6), rng.randrange(1000), i) for i in range(60)]
        frame = spark.createDataFrame(rows, "entity string, q string, ts int, v int, o bigint").repartition(3)
        log.write(frame, {"v": ColumnOutput("m", "q")}, version="ts", order_by="o", batch=batch)
        for e, q, t, v, _ in rows:
            cells[e, q, t] = v
    for n, time_range in ((1, TimeRange()), (2, TimeRange()), (None, TimeRange()), (2, TimeRange.between(1, 5)), (1, TimeRange.before(3))):
        want = {}
        for (e, q, t), v in cells.items():
            if (time_range.begin or 0) <= t < (time_range.end or 99):
                want.setdefault((e, q), []).append((t, v))
        want = {(e, q, t, v) for (e, q), c in want.items() for t, v in sorted(c, reverse=True)[:n]}
        got = scan_cells(log.table(), ColumnRequest("m", max_versions=n), time_range)
        assert {tuple(r) for r in got.select("entity", "qualifier", "version", "value").collect()} == want


def test_a_write_of_many_small_tasks_leaves_few_files(spark, path):
    log = CellLog(spark, path, {"k": "bigint"}, {"f:a": "int", "f:b": "int", "f:c": "int"}).create()
    rows = spark.range(6400).select(F.col("id").alias("k"), *[F.col("id").cast("int").alias(c) for c in "abc"]).repartition(64)
    for _ in range(2):
        log.write(rows, {c: f"f:{c}" for c in "abc"}, version=F.lit(1))
    files = [f for _, _, names in os.walk(f"{path}/cells") for f in names if f.endswith(".parquet")]
    assert len(files) <= 16
    again = log.compact(f"{path}-next")
    read = lambda x: sorted(map(str, x.scan({c: f"f:{c}" for c in "abc"}).collect()))
    assert read(again) == read(log) and spark.read.parquet(f"{path}-next/cells").count() == 3 * 6400


def test_shared_folder(spark):
    class Session:
        """A session that names no folder, or one."""

        def __init__(self, master, named=None):
            self.sparkContext, self.conf = SimpleNamespace(master=master), SimpleNamespace(get=lambda key, default: named or default)

    own = shared_folder(Session("local[2]"))
    assert os.path.isdir(own) and shared_folder(Session("local[2]")) == own
    assert shared_folder(Session("spark://host:1", "hdfs://x/y")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        shared_folder(Session("spark://host:1"))
    assert os.path.isdir(shared_folder(spark)) or "://" in shared_folder(spark)


# --- bases and deltas ---


def exchanges(frame):
    return [line for line in plan(frame).splitlines() if "Exchange" in line and "Broadcast" not in line]


@pytest.fixture
def visits(spark, path):
    """A map family and two single columns, rewritten in part, with a base of four buckets."""
    log = CellLog(spark, path, {"k": "bigint"}, {"m": "double", "f:a": "string", "f:b": "int"}, period=10).create()
    rows = spark.range(400).select(
        (F.col("id") % 40).alias("k"), F.concat(F.lit("q"), F.col("id") % 3).alias("q"), (F.col("id") % 50).alias("ts"),
        F.col("id").cast("double").alias("v"), F.col("id").cast("string").alias("a"), F.col("id").cast("int").alias("b"), F.col("id").alias("o"))
    log.write(rows, {"v": ColumnOutput("m", "q"), "a": "f:a", "b": "f:b"}, version="ts", order_by="o", batch=1)
    log.write(rows.where("id % 7 = 0").withColumn("v", -F.col("v")), {"v": ColumnOutput("m", "q")}, version="ts", order_by="o", batch=2)
    return log


def all_reads(log):
    """Results of scans of every kind, as plain values."""
    frames = [
        scan_cells(log.table(), ColumnRequest("m", max_versions=n), t) for n in (1, 2, 200, ALL_VERSIONS)
        for t in (TimeRange(), TimeRange.between(8, 21), TimeRange.after(30))]
    frames += [log.scan({"m": "m", "a": "f:a", "b": ColumnRequest("f:b", max_versions=3)}), log.scan({"a": "f:a", "b": "f:b"}, TimeRange.before(12))]
    return [sorted(map(str, f.collect())) for f in frames]


def test_scans_of_a_base_exchange_nothing(spark, visits):
    before = all_reads(visits)
    assert exchanges(visits.scan({"m": "m"}))
    visits.rebase(buckets=4)
    table = visits.table()
    for frame in (
        scan_cells(table, ColumnRequest("m")), scan_cells(table, ColumnRequest("m", max_versions=2)), visits.scan({"m": ColumnRequest("m", max_versions=5)}),
        visits.scan({"a": "f:a"}), visits.scan({"a": "f:a", "b": ColumnRequest("f:b", max_versions=2)}),
        visits.scan({"a": "f:a", "m": ColumnRequest("m", max_versions=ALL_VERSIONS)}),
    ):
        assert not exchanges(frame), plan(frame)
        assert "Bucketed: true" in plan(frame)
    assert all_reads(visits) == before


def test_a_later_write_is_exchanged_alone(spark, visits):
    visits.rebase(buckets=4)
    late = spark.createDataFrame([(3, "q0", 3, 1e6, 1), (3, "q9", 60, 2e6, 1), (99, "q0", 1, 3e6, 1)], "k bigint, q string, ts bigint, v double, o bigint")
    visits.write(late, {"v": ColumnOutput("m", "q")}, version="ts", order_by="o", batch=3)
    for frame in (visits.scan({"m": "m"}), scan_cells(visits.table(), ColumnRequest("m", max_versions=2)), visits.scan({"m": "m", "a": "f:a"})):
        found = exchanges(frame)
        assert found and all("REPARTITION_BY_NUM" in line for line in found), plan(frame)
        # what is exchanged is read from the deltas: the base is bucketed, and beside the exchange
        assert plan(frame).count("Bucketed: true") == plan(frame).count("Union")
    newest = {(r.k, r.qualifier): r.value for r in scan_cells(visits.table(), "m").collect()}
    assert newest[3, "q9"] == 2e6 and newest[99, "q0"] == 3e6
    cells = {(r.k, r.qualifier, r.version): r.value for r in scan_cells(visits.table(), ColumnRequest("m", max_versions=ALL_VERSIONS)).collect()}
    assert cells[3, "q0", 3] == 1e6  # rewritten after the base was made
    before = all_reads(visits)
    visits.rebase(buckets=8)
    assert not exchanges(visits.scan({"m": "m"})) and all_reads(visits) == before


def test_a_reader_sees_one_generation(spark, visits):
    visits.rebase(buckets=4)
    old = visits.table()
    before = sorted(map(str, scan_cells(old, "m").collect()))
    late = spark.createDataFrame([(1, "q0", 70, 5.0)], "k bigint, q string, ts bigint, v double")
    seen = visits._cells
    visits._cells = lambda: (found := seen(), visits.write(late, {"v": ColumnOutput("m", "q")}, version="ts"))[0]  # a write while cells are merged
    visits.rebase(buckets=4)
    del visits._cells
    assert sorted(map(str, scan_cells(old, "m").collect())) == before  # opened before the switch
    assert [r.value for r in scan_cells(visits.table(), "m").where("version = 70").collect()] == [5.0]  # not lost
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("cellflow_base_")]:
        spark.sql(f"DROP TABLE {name}")  # a session that knows nothing of the bases; their files stay
    again = CellLog(spark, visits.path, {"k": "bigint"}, {"m": "double", "f:a": "string", "f:b": "int"})
    assert all_reads(again) == all_reads(visits)
    assert all("REPARTITION_BY_NUM" in line for line in exchanges(again.scan({"m": "m"})))
    first = visits._manifest()
    visits._manifest = lambda: first
    visits.rebase(buckets=4)
    with pytest.raises(AnalysisException):
        visits.rebase(buckets=4)  # another merge took this number


def test_time_ranges_prune_files(spark, visits):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    for step in range(2):
        frame = scan_cells(visits.table(), ColumnRequest("m", max_versions=ALL_VERSIONS), TimeRange.between(10, 20))
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(frame))[1]
        assert re.search(r"low#\d+L < 20", filters) and re.search(r"high#\d+L >= 10", filters)
        pruned = visits._cells()[0].where("column = 'm' AND low < 20 AND high >= 10").select(F.min("low"), F.max("high")).first()
        assert tuple(pruned) == (0, 20)
        visits.rebase(buckets=4)
    extremes = spark.createDataFrame([(7, v) for v in (-(1 << 63), -5, -1, (1 << 63) - 1)], "k bigint, ts bigint")
    visits.write(extremes.withColumn("b", F.lit(1)), {"b": "f:b"}, version="ts")
    found = lambda t: sorted(r.version for r in scan_cells(visits.table(), ColumnRequest("f:b", max_versions=ALL_VERSIONS), t).where("k = 7 AND value = 1").collect())
    assert found(TimeRange.before(0)) == [-(1 << 63), -5, -1] and found(TimeRange.after((1 << 63) - 1)) == [(1 << 63) - 1]
    assert found(TimeRange.between(-5, -1)) == [-5] and found(TimeRange.at(-(1 << 63))) == [-(1 << 63)]
    with pytest.raises(ValueError):
        CellLog(spark, visits.path, {"k": "bigint"}, {}, period=0)


def test_random_writes_and_bases_against_a_dictionary(spark, path):
    rng = random.Random(5)
    log = CellLog(spark, path, {"entity": "string", "part": "int"}, {"m": "int"}, period=3).create()
    cells = {}
    for batch in range(4):
        rows = [(f"e{rng.randrange(4)}", rng.randrange(2), f"q{rng.randrange(3)}", rng.randrange(9), rng.randrange(1000), i) for i in range(60)]
        frame = spark.createDataFrame(rows, "entity string, part int, q string, ts int, v int, o bigint").repartition(3)
        log.write(frame, {"v": ColumnOutput("m", "q")}, version="ts", order_by="o", batch=batch)
        for e, p, q, t, v, _ in rows:
            cells[e, p, q, t] = v
        if batch % 2:
            log.rebase(buckets=3)
        got = scan_cells(log.table(), ColumnRequest("m", max_versions=ALL_VERSIONS))
        assert {(tuple(r)[:4], r.value) for r in got.select("entity", "part", "qualifier", "version", "value").collect()} == set(cells.items())


def test_a_broken_own_table_is_not_an_unwritten_one(spark, path):
    log = CellLog(spark, path, {"k": "bigint"}, {"f:any": None}).create()
    assert log.table() is not None
    os.makedirs(f"{path}/own/f.any")
    with open(f"{path}/own/f.any/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        log.table()
