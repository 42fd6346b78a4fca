import random
import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cellflow.functions import first_token
from cellflow.operators.slices import first_value, slice_size, values
from cellflow.sources.cells import CellTable, LongCells, MissingColumns, Version, WideCells
from cellflow.sources.requests import (
    ALL_VERSIONS, And, Cell, ColumnRequest, DataRequest, Or, Range, Regex, TimeRange,
)
from cellflow.sources.scan import scan, scan_cells, scan_pages, skipped_entities
from tests.helpers import cell_table, cell_view, plan, slices

HELLO = [("row01", "column1", 1, "hello"), ("row02", "column1", 2, "hello"),
         ("row03", "column1", 1, "world"), ("row04", "column1", 3, "hello")]
VERSIONS = [("row01", "column1", v, str(v)) for v in (10, 20)] \
    + [("row02", "column1", v, str(v)) for v in (10, 20, 30)] + [("row03", "column1", 10, "10")]
TWO = [(e, c, 1, c[-1]) for e in ("row01", "row02", "row03", "row04") for c in ("column1", "column2")
       if (e, c) != ("row02", "column2")]
GROUP = ["column1", "column2"]


def group_table(spark, rows):
    return cell_table(cell_view(spark, "family", rows, qualifiers=GROUP))


def test_word_count_over_newest_cells(spark):  # X1
    rows = scan(group_table(spark, HELLO), {"word": "family:column1"})
    got = rows.groupBy(F.lower(first_value("word")).alias("w")).count().collect()
    assert {r.w: r["count"] for r in got} == {"hello": 3, "world": 1}


def test_latest_two_versions(spark):  # X2
    request = ColumnRequest("family:column1", max_versions=2)
    got = slices(scan(group_table(spark, VERSIONS), {"words": request}), "words")
    assert sorted(len(s) for s in got.values()) == [1, 2, 2]
    assert [c[1] for c in got["row02"]] == [30, 20]


def test_time_range_before_limit(spark):  # X3
    got = slices(scan(group_table(spark, VERSIONS), {"w": "family:column1"}, TimeRange.between(15, 25)), "w")
    assert {e: [c[1] for c in s] for e, s in got.items()} == {"row01": [20], "row02": [20]}


@pytest.mark.parametrize("time_range, expected", [
    (TimeRange(), [30, 20, 10]), (TimeRange.at(20), [20]), (TimeRange.after(20), [30, 20]),
    (TimeRange.before(20), [10]), (TimeRange.between(10, 30), [20, 10]), (TimeRange.between(10, 10), None),
])
def test_time_ranges(spark, time_range, expected):  # X41
    request = ColumnRequest("family:column1", max_versions=ALL_VERSIONS)
    got = slices(scan(group_table(spark, VERSIONS), {"w": request}, time_range), "w").get("row02")
    assert (got and [c[1] for c in got]) == expected


def test_bad_time_range():  # X41
    with pytest.raises(ValueError):
        TimeRange.between(10, 1)
    assert TimeRange.at(2**63 - 1) == TimeRange(2**63 - 1, None)


def test_missing_column_drops_row(spark):  # X4
    got = scan(group_table(spark, TWO), {"a": "family:column1", "b": "family:column2"})
    assert sorted(r.entity for r in got.collect()) == ["row01", "row03", "row04"]


def test_missing_column_replaced(spark):  # X5
    second = ColumnRequest("family:column2").replace_missing_with("missing")
    got = scan(group_table(spark, TWO), {"a": "family:column1", "b": second})
    pluralised = got.select("entity", F.concat(first_value("b"), F.lit("s")).alias("v")).collect()
    assert {r.entity: r.v for r in pluralised} == {"row01": "2s", "row02": "missings", "row03": "2s", "row04": "2s"}
    assert slices(got, "b")["row02"] == [("column2", 2**63 - 1, "missing")]


def test_default_forms(spark):
    many = ColumnRequest("family:column2").replace_missing_with_versioned((1, "old"), (5, "new"))
    got = slices(scan(group_table(spark, TWO), {"a": "family:column1", "b": many}), "b")
    assert got["row02"] == [("column2", 5, "new"), ("column2", 1, "old")]
    family = ColumnRequest("animals", max_versions=2).replace_missing_with(("cat", "x"), ("ant", "y"))
    rows = [("row01", "column1", 1, "a")]
    table = cell_table(cell_view(spark, "family", rows, qualifiers=GROUP),
                       cell_view(spark, "animals", [("row09", "dog", 1, "z")]))
    got = slices(scan(table, {"a": "family:column1", "m": family}), "m")
    assert got == {"row01": [("ant", 2**63 - 1, "y"), ("cat", 2**63 - 1, "x")]}
    with pytest.raises(ValueError):
        ColumnRequest("animals", default=(Cell("x"),))


def test_all_defaults_and_universe(spark):
    first = ColumnRequest("family:column1").replace_missing_with("-")
    second = ColumnRequest("family:column2").replace_missing_with("-")
    table = group_table(spark, [("row01", "column1", 1, "a"), ("row02", "column2", 1, "b")])
    columns = {"a": first, "b": second}
    got = scan(table, columns).select("entity", first_value("a").alias("a"), first_value("b").alias("b"))
    assert {tuple(r) for r in got.collect()} == {("row01", "a", "-"), ("row02", "-", "b")}
    universe = spark.createDataFrame([("row02",), ("row07",)], "entity string")
    got = scan(table, columns, universe=universe).select("entity", first_value("a"), first_value("b"))
    assert {tuple(r) for r in got.collect()} == {("row02", "-", "b"), ("row07", "-", "-")}


def test_family_keeps_versions_per_qualifier(spark):
    rows = [("e", q, v, f"{q}{v}") for q in ("b", "a") for v in (1, 2, 3)]
    got = slices(scan(cell_table(cell_view(spark, "m", rows)), {"s": ColumnRequest("m", max_versions=2)}), "s")
    assert got["e"] == [("a", 3, "a3"), ("a", 2, "a2"), ("b", 3, "b3"), ("b", 2, "b2")]


def test_single_qualifier_of_map_family(spark):  # X9
    rows = [(f"{i}row", "0column", 0, v) for i, v in enumerate(["0 dogs", "1 cat", "2 fish"])] \
        + [("0row", "other", 0, "no")]
    got = scan(cell_table(cell_view(spark, "animals", rows)), {"a": "animals:0column"})
    assert {r.v for r in got.select(first_value("a").alias("v")).collect()} == {"0 dogs", "1 cat", "2 fish"}


def test_rewritten_cell_keeps_last_write(spark):
    rows = [("e", "q", 1, "first", 1), ("e", "q", 1, "second", 2), ("e", "q", 2, "new", 0), ("e", "q", 0, "zero", 9)]
    table = cell_table(cell_view(spark, "m", rows, ordered=True))
    for n, expected in ((1, [(2, "new")]), (2, [(2, "new"), (1, "second")]),
                        (5000, [(2, "new"), (1, "second"), (0, "zero")]),
                        (ALL_VERSIONS, [(2, "new"), (1, "second"), (0, "zero")])):
        got = slices(scan(table, {"s": ColumnRequest("m:q", max_versions=n)}), "s")
        assert [c[1:] for c in got["e"]] == expected


def test_several_columns_with_versions(spark):
    rows = [(e, q, v, f"{e}{q}{v}", v) for e in "xyz" for q in ("a", "b", "c") for v in (1, 2, 3) if (e, q) != ("y", "b")]
    table = cell_table(cell_view(spark, "m", rows, ordered=True))
    for n in (2, ALL_VERSIONS):
        columns = {q: ColumnRequest(f"m:{q}", max_versions=n) for q in ("a", "b")}
        got = slices(scan(table, columns), "a", "b")
        assert sorted(got) == ["x", "z"]
        assert got["x"][1] == [("b", v, f"xb{v}") for v in (3, 2, 1)][: n or 3]
        columns["b"] = columns["b"].replace_missing_with("none")
        assert slices(scan(table, columns), "b")["y"] == [("b", 2**63 - 1, "none")]


def test_slice_size_check(spark):
    rows = [("hot", q, v, "x") for q in ("a", "b") for v in range(40)] + [("cold", "a", 1, "x"), ("cold", "b", 1, "x")]
    table = cell_table(cell_view(spark, "m", rows))
    whole = {"s": ColumnRequest("m", max_versions=ALL_VERSIONS)}
    assert scan(table, whole, max_cells=80).count() == 2
    with pytest.raises(Exception, match="more than 79 cells"):
        scan(table, whole, max_cells=79).collect()
    pair = {q: ColumnRequest(f"m:{q}", max_versions=ALL_VERSIONS) for q in ("a", "b")}
    with pytest.raises(Exception, match="more than 50 cells"):
        scan(table, pair, max_cells=50).collect()
    assert scan(table, {"s": ColumnRequest("m", max_versions=2)}, max_cells=4).count() == 2


def test_filters(spark):  # F1-F4, X42
    rows = [("e", q, 1, q) for q in ("apple", "apricot", "banana", "cherry", "ap")]
    table = cell_table(cell_view(spark, "m", rows))

    def names(f):
        return {r.qualifier for r in scan_cells(table, ColumnRequest("m", filter=f)).collect()}

    assert names(Regex("ap.*")) == {"apple", "apricot", "ap"}
    assert names(Regex("ap")) == {"ap"}
    assert names(Regex("app?")) == {"ap"}
    assert names(Regex("a|banana")) == {"banana"}
    assert names(Regex("ap{1}")) == {"ap"}
    assert names(Range("apple", "banana")) == {"apple", "apricot"}
    assert names(Range("apple", "banana", False, True)) == {"apricot", "banana"}
    assert names(Range(high="apple")) == {"ap"}
    assert names(And([Regex("a.*"), Range(low="apq")])) == {"apricot"}
    assert names(Or([Regex("b.*"), Range(low="c")]) & Regex(".*y")) == {"cherry"}
    for n in (1, 2):  # a filter may also stand beside a single column
        kept, gone = (ColumnRequest(f"m:{q}", max_versions=n, filter=Regex("a.*")) for q in ("apple", "banana"))
        assert scan(table, {"k": kept}).count() == 1 and scan(table, {"k": kept, "g": gone}).count() == 0
        assert scan(table, {"k": kept, "g": gone.replace_missing_with("-")}).count() == 1


def test_pages_give_the_slice(spark):  # X13
    rows = [("e", "q", v, w) for v, w in enumerate(["hello", "world", "hello", "hello"], 1)]
    request = ColumnRequest("m:q", max_versions=ALL_VERSIONS, page_size=3)
    pages = scan_pages(cell_table(cell_view(spark, "m", rows)), request)
    got = pages.orderBy("page").collect()
    assert "".join(c.value for r in got for c in r.cells) == "hellohelloworldhello"
    assert max(len(r.cells) for r in got) <= 3
    words = pages.select(F.explode(values("cells")).alias("w")).groupBy("w").count().collect()
    assert {r.w: r["count"] for r in words} == {"hello": 3, "world": 1}


def test_pages_of_many_entities_match_long_cells(spark):
    rows = [(f"e{i % 3}", f"q{i % 7}", i, str(i)) for i in range(500)] + [("hot", "q", i, str(i)) for i in range(900)]
    table = cell_table(cell_view(spark, "m", rows))
    request = ColumnRequest("m", max_versions=ALL_VERSIONS, page_size=7)
    pages = {}
    for r in scan(table, {"s": request}).collect():
        assert 1 <= len(r.s) <= 7
        pages.setdefault(r.entity, {})[r.s_page] = [tuple(c) for c in r.s]
    whole = slices(scan(table, {"s": ColumnRequest("m", max_versions=ALL_VERSIONS)}), "s")
    assert {e: [c for p in sorted(ps) for c in ps[p]] for e, ps in pages.items()} == whole


def test_pages_beside_another_column(spark):
    table = cell_table(cell_view(spark, "m", [("a", "q", v, str(v)) for v in range(5)] + [("b", "q", 1, "x")]),
                       cell_view(spark, "n", [("a", "k", 1, "A"), ("c", "k", 1, "C")]))
    paged = ColumnRequest("m", max_versions=ALL_VERSIONS, page_size=2)
    got = scan(table, {"s": paged, "n": "n:k"}).select("entity", slice_size("s").alias("k"), first_value("n").alias("v"))
    assert {r.entity for r in got.collect()} == {"a"} and sum(r.k for r in got.collect()) == 5
    paged = paged.replace_missing_with(("d", "dflt"))
    got = scan(table, {"s": paged, "n": "n:k"}).select("entity", F.explode(values("s")).alias("v")).collect()
    assert sorted(tuple(r) for r in got) == [("a", str(i)) for i in range(5)] + [("c", "dflt")]


def test_counters_and_skipped(spark):  # A10
    table = group_table(spark, TWO)
    columns = {"a": "family:column1", "b": "family:column2"}
    seen = Observation("scan")
    assert scan(table, columns, counters=seen).count() == 3
    assert seen.get == {"rows_read": 4, "rows_skipped": 1}
    assert [tuple(r) for r in skipped_entities(table, columns).collect()] == [("row02", ["family:column2"])]


def test_reader_fields(spark):  # X18, A11, A12
    rows = [("e", "r", 1, ("MD5", 13, True))]
    view = cell_view(spark, "family", rows, "struct<hash_type:string,hash_size:int,suppress:boolean>", ["r"])
    table = cell_table(view)
    full = scan(table, {"r": "family:r"}).select(first_value("r").hash_size).first()[0]
    narrow = scan(table, {"r": ColumnRequest("family:r", fields=("hash_size",))})
    assert full == 13 and narrow.select(first_value("r")).first()[0].asDict() == {"hash_size": 13}
    with pytest.raises(MissingColumns, match="no_such"):
        scan(table, {"r": ColumnRequest("family:r", fields=("no_such",))})
    default = ColumnRequest("family:q", default=(Cell((5,)),), fields=("hash_size",))
    more = cell_view(spark, "family", [("f", "q", 1, ("SHA", 1, True)), ("e", "r", 1, ("MD5", 13, True))],
                     "struct<hash_type:string,hash_size:int,suppress:boolean>", ["r", "q"])
    got = scan(cell_table(more), {"r": "family:r", "q": default}).select(first_value("q").hash_size).collect()
    assert got == [(5,)]


def test_reader_fields_prune_the_file(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"
    rows = [("e", "r", 1, ("MD5", 13, True)), ("e", "r", 2, None)]
    schema = "entity string, qualifier string, version bigint, value struct<hash_type:string,hash_size:int,suppress:boolean>"
    spark.createDataFrame(rows, schema).write.parquet(path)
    view = LongCells(spark.read.parquet(path), "f", {"entity": "entity"}, "qualifier", Version.number("version"), "value")
    got = scan_cells(cell_table(view), ColumnRequest("f", max_versions=2, fields=("hash_size",)))
    assert "value:struct<hash_size:int>>" in plan(got).split("ReadSchema")[1]
    assert [r.value and r.value.hash_size for r in got.orderBy("version").collect()] == [13, None]


def test_map_values_can_be_sliced(spark):
    rows = [("e", "q", 1, {"a": 1}), ("e", "q", 2, {"b": 2}), ("e", "p", 2, {})]
    table = cell_table(cell_view(spark, "m", rows, "map<string,int>"))
    got = slices(scan(table, {"s": ColumnRequest("m", max_versions=ALL_VERSIONS)}), "s")
    assert got["e"] == [("p", 2, {}), ("q", 2, {"b": 2}), ("q", 1, {"a": 1})]


def test_zero_columns(spark):  # A14
    assert {r.entity for r in scan(group_table(spark, TWO), {}).collect()} == {"row01", "row02", "row03", "row04"}


def test_validation_names_every_fault(spark):  # X23
    with pytest.raises(MissingColumns) as e:
        scan(group_table(spark, TWO), {"a": "family:nope", "b": "other"})
    assert "family:nope" in str(e.value) and "other" in str(e.value)
    with pytest.raises(ValueError):
        ColumnRequest.family("a:b")
    with pytest.raises(ValueError):
        DataRequest({"a": "family:column1", "b": "family:column1"})


def wide_table(spark):
    frame = spark.createDataFrame(
        [(1, "x", 5, 1.5), (2, None, 6, 2.5), (3, "z", None, None)], "k bigint, name string, n int, bal double")
    return CellTable(["entity"], [WideCells(frame, "p", {"entity": "k"}, {"name": "name", "n": "n", "bal": "bal"})])


def test_wide_view_needs_no_exchange(spark):
    table = wide_table(spark)
    got = scan(table, {"name": "p:name", "n": ColumnRequest("p:n").replace_missing_with(0)})
    assert "Exchange" not in plan(got)
    rows = got.select("entity", first_value("name").alias("a"), first_value("n").alias("b")).collect()
    assert {tuple(r) for r in rows} == {(1, "x", 5), (3, "z", 0)}
    assert {(r.entity, r.value) for r in scan_cells(table, "p:bal").collect()} == {(1, 1.5), (2, 2.5)}
    assert {r.entity for r in scan(table, {}).collect()} == {1, 2, 3}
    assert scan(table, {"n": "p:n"}, TimeRange.after(1)).count() == 0


def test_data_request(spark):  # F5
    request = DataRequest({"w": ColumnRequest("family:column1", max_versions=2)}, TimeRange.before(30))
    got = slices(scan(group_table(spark, VERSIONS), request), "w")
    assert [c[1] for c in got["row02"]] == [20, 10]


def test_plan_shapes(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    view = LongCells(events, "activity", {"entity": "user_id"}, "event_type", Version.micros_of("ts"), "value")
    table = cell_table(view)
    day = TimeRange.between(1704153600000000, 1704240000000000)
    newest = plan(scan_cells(table, "activity", day))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in newest
    assert newest.count("Exchange") == 1 and "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in newest
    three = plan(scan_cells(table, ColumnRequest("activity", max_versions=3)))
    assert three.count("WindowGroupLimit") == 2 and three.count("Exchange") == 1
    pair = plan(scan(table, {"a": "activity:click", "b": "activity:view"}))
    assert pair.count("Exchange") == 1 and "Join" not in pair
    several = plan(scan(table, {q: ColumnRequest(f"activity:{q}", max_versions=3) for q in ("click", "view")}))
    assert several.count("FileScan") == 1 and several.count("Exchange") == 2 and "Join" not in several
    single = plan(scan(table, {"a": ColumnRequest("activity:click", max_versions=3)}))
    assert single.count("Exchange") == 1 and "EqualTo(event_type,click)" in single
    prefix = plan(scan_cells(table, ColumnRequest("activity", filter=Regex("cl.*"))))
    assert "StringStartsWith(event_type,cl)" in prefix


def test_join_on_a_derived_key(spark):  # X10
    rows = [(f"{i}row", "0column", 0, v) for i, v in enumerate(["0 dogs", "1 cat", "2 fish"])]
    animals = scan(cell_table(cell_view(spark, "animals", rows)), {"a": "animals:0column"})
    keyed = animals.select(F.concat(first_token(first_value("a")), F.lit("row")).alias("key"), first_value("a").alias("v"))
    side = spark.createDataFrame([("0row",), ("2row",)], "line string")
    assert {r.v for r in keyed.join(side, keyed.key == side.line).collect()} == {"0 dogs", "2 fish"}


def test_pages_do_not_depend_on_the_partitioning(spark):
    rows = [(f"e{i}", f"q{c % 7}", c, float(c)) for i in range(10) for c in range(20 if i else 500)]
    view = cell_view(spark, "f", rows, "double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for parts in (3, 9):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        pages = scan_pages(cell_table(view), ColumnRequest("f", max_versions=None), 7).collect()
        got.append(sorted((r.entity, r.page, [tuple(c) for c in r.cells]) for r in pages))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
    sizes = [len(c) for e, _, c in got[0] if e == "e3"]
    assert sizes == [7, 7, 6] and [p for e, p, _ in got[0] if e == "e0"] == list(range(72))


def test_newest_versions_of_rewritten_cells(spark):
    rng = random.Random(4)
    rows = [(f"e{rng.randint(0, 3)}", f"q{rng.randint(0, 2)}", rng.randint(0, 9), float(k), k) for k in range(900)]
    view = cell_view(spark, "f", rows, "double", ordered=True)
    want = {}
    for e, q, v, x, k in rows:
        want.setdefault((e, q), {})[v] = x
    for n in (2, 3):
        cells = scan_cells(cell_table(view), ColumnRequest("f", max_versions=n)).collect()
        newest = {(e, q, v, x) for (e, q), c in want.items() for v, x in sorted(c.items(), reverse=True)[:n]}
        assert {tuple(r) for r in cells} == newest and len(cells) == len(newest)
