"""Queries over the driver tables, one or more per operator, each over whole tables.

The views of the tables as cell tables come first; ``QUERIES`` maps names to functions of
``(spark, folder)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cellflow import functions as C
from cellflow.operators import slices as S
from cellflow.operators.folds import fold_rows
from cellflow.operators.itemsets import (
    capped_counts, filter_by_support, frequent_item_sets, gather_baskets, item_sets,
)
from cellflow.operators.joins import cross_with_row, join_with_count, join_with_group_count
from cellflow.operators.nested import conform, pack, require_type, unpack
from cellflow.operators.paged import first_of_pages, fold_pages, group_pages, last_of_pages, page_stats
from cellflow.operators.versions import newest, oldest
from cellflow.plans.phases import (
    ALL, Distance, Environment, Evaluator, Extractor, Model, PhaseEnvironment, ScoreEnvironment, Scorer,
    SideLookup, evaluate_rows, first_value_extractor, last_value_extractor, run_model, score_rows, slice_extractor,
)
from cellflow.plans.regression import train_linear
from cellflow.session import shared_folder
from cellflow.sources.cell_log import CellColumns, CellLog, ColumnOutput, write_outputs
from cellflow.sources.cells import CellTable, LongCells, Version, WideCells
from cellflow.sources.requests import ALL_VERSIONS, And, ColumnRequest, DataRequest, Or, Range, Regex, TimeRange
from cellflow.sources.scan import scan, scan_cells, scan_pages, skipped_entities
from cellflow.sources.files import ParquetFile, placed_lines, sequence_file, text_lines, write_sequence_file, write_text, write_tsv
from cellflow.sources.side_data import contains_key, delimited_text, key_values, lookup, records, table_column

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(year: int, month: int, day_of_month: int) -> int:
    """Version of a day's start."""
    return int((datetime(year, month, day_of_month) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000


# --- views -----------------------------------------------------------------------------------


def activity(spark: SparkSession, folder: str) -> CellTable:
    """A map-type family by user: event type, microseconds of the event, value."""
    view = LongCells(
        read(spark, folder, "events"), "activity", {"user_id": "user_id"}, "event_type",
        Version.micros_of("ts"), "value", write_order="event_id",
    )
    return CellTable(["user_id"], [view])


def customers(spark: SparkSession, folder: str) -> CellTable:
    """Group-type profile columns and a map-type family of order totals by priority."""
    profile = WideCells(
        read(spark, folder, "customer"), "profile", {"custkey": "c_custkey"},
        {"name": "c_name", "nation": "c_nationkey", "acctbal": "c_acctbal", "segment": "c_mktsegment"},
    )
    spend = LongCells(
        read(spark, folder, "orders"), "spend", {"custkey": "o_custkey"}, "o_orderpriority",
        Version.micros_of("o_orderdate"), "o_totalprice", write_order="o_orderkey",
    )
    return CellTable(["custkey"], [profile, spend])


def texts(spark: SparkSession, folder: str) -> CellTable:
    """Documents, with labels that only some of them have."""
    doc = WideCells(
        read(spark, folder, "documents"), "doc", {"doc_id": "doc_id"},
        {"text": "text", "lang": "lang", "source": "source", "chars": "n_chars"},
    )
    label = WideCells(read(spark, folder, "labels"), "label", {"doc_id": "doc_id"}, {"quality": "quality", "toxic": "toxic"})
    return CellTable(["doc_id"], [doc, label])


def order_brands(spark: SparkSession, folder: str) -> DataFrame:
    """(order, brand) rows, one per line item."""
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = read(spark, folder, "part").select("p_partkey", "p_brand")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select("l_orderkey", "p_brand")


def cents(c) -> object:
    return F.round(c * 100).cast("bigint")


ACTIVITY_3 = ColumnRequest("activity", max_versions=3)
ACTIVITY_ALL = ColumnRequest("activity", max_versions=ALL_VERSIONS)


def event_rows(cells: DataFrame) -> DataFrame:
    return cells.withColumnRenamed("qualifier", "event_type")


# --- scans (A, E, F) ---------------------------------------------------------------------------


@query
def latest_cell_family(spark, folder):
    return event_rows(scan_cells(activity(spark, folder), "activity"))


@query
def latest_n_versions(spark, folder):
    return event_rows(scan_cells(activity(spark, folder), ACTIVITY_3))


@query
def time_range_between(spark, folder):
    window = TimeRange.between(day(2024, 1, 10), day(2024, 1, 12))
    return event_rows(scan_cells(activity(spark, folder), "activity", window))


@query
def time_range_after(spark, folder):
    return event_rows(scan_cells(activity(spark, folder), ACTIVITY_3, TimeRange.after(day(2024, 1, 28))))


@query
def time_range_before(spark, folder):
    return event_rows(scan_cells(activity(spark, folder), "activity", TimeRange.before(day(2024, 1, 3))))


@query
def time_range_at(spark, folder):
    cells = scan_cells(customers(spark, folder), ColumnRequest("spend", max_versions=ALL_VERSIONS), TimeRange.at(day(1998, 2, 6)))
    return cells.withColumnRenamed("qualifier", "priority")


@query
def entities_scan(spark, folder):
    return scan(activity(spark, folder), {})


@query
def missing_rows_dropped(spark, folder):
    rows = scan(texts(spark, folder), {"lang": "doc:lang", "quality": "label:quality", "toxic": "label:toxic"})
    return rows.select("doc_id", *[S.first_value(c).alias(c) for c in ("lang", "quality", "toxic")])


@query
def missing_replaced(spark, folder):
    columns = {"lang": "doc:lang", "quality": ColumnRequest("label:quality").replace_missing_with(-1)}
    rows = scan(texts(spark, folder), columns)
    return rows.select("doc_id", S.first_value("lang").alias("lang"), S.first_value("quality").alias("quality"))


@query
def all_missing_replaced(spark, folder):
    columns = {
        "quality": ColumnRequest("label:quality").replace_missing_with(-1),
        "toxic": ColumnRequest("label:toxic", max_versions=2).replace_missing_with_versioned((1, -1), (2, -2)),
    }
    universe = read(spark, folder, "documents").select("doc_id")
    rows = scan(texts(spark, folder), columns, universe=universe)
    return rows.select(
        "doc_id", S.first_value("quality").alias("quality"), S.first_value("toxic").alias("toxic"),
        S.slice_size("toxic").cast("bigint").alias("cells"),
    )


@query
def multi_column_profile(spark, folder):
    columns = {c: f"profile:{c}" for c in ("name", "nation", "acctbal", "segment")}
    rows = scan(customers(spark, folder), columns)
    return rows.select("custkey", *[S.first_value(c).alias(c) for c in columns])


@query
def multi_view_scan(spark, folder):
    """Profile and order columns of one entity: the order side is grouped once for both fields."""
    columns = {
        "segment": "profile:segment", "urgent": "spend:1-URGENT",
        "low": ColumnRequest("spend:5-LOW").replace_missing_with(0.0),
    }
    rows = scan(customers(spark, folder), columns)
    return rows.select(
        "custkey", S.first_value("segment").alias("segment"), S.first_value("urgent").alias("urgent"),
        S.first_value("low").alias("low"),
    )


@query
def regex_qualifier(spark, folder):
    request = ColumnRequest("activity", filter=Regex("(pur|si).*"))
    return event_rows(scan_cells(activity(spark, folder), request))


@query
def range_qualifier(spark, folder):
    request = ColumnRequest("activity", filter=Range("error", "signup"))
    return event_rows(scan_cells(activity(spark, folder), request))


@query
def and_or_qualifier(spark, folder):
    some = Or([And([Regex(".*i.*"), Range("s", None)]), Range(None, "click", high_included=True)])
    return event_rows(scan_cells(activity(spark, folder), ColumnRequest("activity", filter=some)))


@query
def data_request_scan(spark, folder):
    request = DataRequest(
        {"prices": ColumnRequest("spend", max_versions=2, filter=Range("2", "5"))},
        TimeRange.between(day(1995, 1, 1), day(1997, 1, 1)),
    )
    rows = scan(customers(spark, folder), request)
    return rows.select(
        "custkey", S.slice_size("prices").cast("bigint").alias("cells"), F.round(S.slice_sum("prices"), 2).alias("total")
    )


@query
def scan_counters(spark, folder):
    """What the scan itself counts while its rows are written."""
    counters = Observation("counters")
    rows = scan(texts(spark, folder), {"lang": "doc:lang", "quality": "label:quality"}, counters=counters)
    kept = scratch(spark, "kept")
    rows.select("doc_id").write.parquet(kept)
    seen = counters.get
    return spark.read.parquet(kept).agg(
        F.count("*").alias("rows_kept"), F.lit(seen["rows_read"]).cast("bigint").alias("rows_read"),
        F.lit(seen["rows_skipped"]).cast("bigint").alias("rows_skipped"))


@query
def skipped_rows(spark, folder):
    rows = skipped_entities(texts(spark, folder), {"lang": "doc:lang", "quality": "label:quality"})
    return rows.select("doc_id", F.array_join("missing", ",").alias("missing"))


@query
def paged_scan(spark, folder):
    """Whole histories in pages of 20 cells; a hot user is cut into many pages."""
    pages = scan_pages(activity(spark, folder), ACTIVITY_ALL, page_size=20)
    return pages.select(
        "user_id", "page", F.size("cells").cast("bigint").alias("cells"), F.round(S.slice_sum("cells"), 2).alias("total"),
        F.array_max(F.transform("cells", lambda c: c.version)).alias("newest"),
    )


@query
def wide_time_range(spark, folder):
    """Orders as a wide view whose version is the order date: the range and the null checks reach the files."""
    view = WideCells(
        read(spark, folder, "orders"), "order", {"orderkey": "o_orderkey"}, {"status": "o_orderstatus", "price": "o_totalprice"},
        Version.micros_of("o_orderdate"),
    )
    rows = scan(CellTable(["orderkey"], [view]), {"status": "order:status", "price": "order:price"}, TimeRange.after(day(1996, 1, 1)))
    return rows.select("orderkey", S.first_value("status").alias("status"), S.first_value("price").alias("price"))


@query
def reader_projection(spark, folder):
    rows = read(spark, folder, "customer").select(
        "c_custkey", F.struct("c_name", "c_acctbal", "c_nationkey").alias("person")
    )
    table = CellTable(["custkey"], [WideCells(rows, "info", {"custkey": "c_custkey"}, {"person": "person"})])
    narrow = scan(table, {"person": ColumnRequest("info:person", fields=("c_acctbal",))})
    return narrow.select("custkey", S.first_value("person").c_acctbal.alias("acctbal"))


# --- slices (S, G8) ------------------------------------------------------------------------------


def rounded_stats(stats: DataFrame, by: list[str]) -> DataFrame:
    # Digits chosen so that no measure of two-decimal values is likely to sit on a rounding tie.
    digits = {"sum": 4, "sum_squares": 6, "avg": 9, "variance": 2, "stddev": 6, "min": 4, "max": 4}
    return stats.select(
        *by, F.col("size").cast("bigint").alias("size"), *[F.round(m, d).alias(m) for m, d in digits.items()]
    )


@query
def slice_stats(spark, folder):
    cells = scan_cells(activity(spark, folder), ACTIVITY_ALL)
    return rounded_stats(S.cell_stats(cells, ["user_id"]), ["user_id"])


@query
def slice_stats_by_qualifier(spark, folder):
    cells = event_rows(scan_cells(activity(spark, folder), ACTIVITY_ALL))
    return rounded_stats(S.cell_stats(cells, ["event_type"]), ["event_type"])


@query
def slice_stats_of_newest(spark, folder):
    """The array forms, on slices bounded by three versions."""
    rows = scan(activity(spark, folder), {"s": ACTIVITY_3})
    stats = rows.select(
        "user_id", S.slice_size("s").alias("size"), S.slice_sum("s").alias("sum"),
        S.slice_sum_squares("s").alias("sum_squares"), S.slice_avg("s").alias("avg"),
        S.slice_variance("s").alias("variance"), S.slice_stddev("s").alias("stddev"),
        S.slice_min("s").alias("min"), S.slice_max("s").alias("max"),
    )
    return rounded_stats(stats, ["user_id"])


@query
def slice_first_last(spark, folder):
    cells = scan_cells(activity(spark, folder), ACTIVITY_ALL)
    return event_rows(cells).groupBy("user_id", "event_type").agg(
        newest("value").alias("newest"), oldest("value").alias("oldest"), F.count("*").alias("cells")
    )


@query
def slice_orders(spark, folder):
    """The orderings of a bounded slice: canonical, by time both ways, by value, by qualifier."""
    rows = scan(activity(spark, folder), {"s": ColumnRequest("activity", max_versions=2)})

    def shown(s):
        return F.array_join(F.transform(s, lambda c: cents(c.value).cast("string")), ",")

    return rows.select(
        "user_id",
        shown(F.col("s")).alias("canonical"),
        shown(S.chronological("s")).alias("oldest_first"),
        shown(S.reverse_chronological("s")).alias("newest_first"),
        shown(S.order_by("s", lambda c: F.struct(c.value, c.version))).alias("by_value"),
        shown(S.by_qualifier(S.chronological("s"))).alias("by_qualifier"),
        cents(S.first_value("s")).alias("first"),
        cents(S.last_value("s")).alias("last"),
    )


@query
def slice_groups(spark, folder):
    rows = scan(activity(spark, folder), {"s": ACTIVITY_3})
    groups = rows.select("user_id", F.explode(S.group_by_qualifier("s")).alias("event_type", "part"))
    return groups.select(
        "user_id", "event_type", S.slice_size("part").cast("bigint").alias("cells"),
        cents(S.first_value("part")).alias("newest"),
    )


@query
def slice_groups_by_value(spark, folder):
    rows = scan(activity(spark, folder), {"s": ACTIVITY_3})
    groups = S.group_cells("s", lambda c: F.floor(c.value / 50))
    exploded = rows.select("user_id", F.explode(groups).alias("band", "part"))
    return exploded.select("user_id", "band", S.slice_size("part").cast("bigint").alias("cells"))


@query
def slice_fold(spark, folder):
    """A left fold: running value halved at every cell, newest first."""
    rows = scan(activity(spark, folder), {"s": ColumnRequest("activity:purchase", max_versions=3)})
    halved = S.fold("s", F.lit(0.0), lambda acc, c: acc / 2 + c.value)
    return rows.select("user_id", F.round(halved, 4).alias("folded"))


@query
def slice_equality(spark, folder):
    """Users whose newest purchase was already there in mid-month."""
    table = activity(spark, folder)
    now = scan(table, {"now": "activity:purchase"})
    then = scan(table, {"earlier": "activity:purchase"}, TimeRange.before(day(2024, 1, 25)))
    return now.join(then, "user_id").select("user_id", S.same_slice("now", "earlier").alias("unchanged"))


@query
def version_count_histogram(spark, folder):
    sizes = scan_cells(activity(spark, folder), ACTIVITY_ALL).groupBy("user_id", "qualifier").agg(F.count("*").alias("versions"))
    return sizes.groupBy("versions").agg(F.count("*").alias("slices"))


# --- rows, grouping and scalar functions (P, G, C) ---------------------------------------------


@query
def word_count(spark, folder):
    cells = scan_cells(texts(spark, folder), "doc:text")
    words = cells.select(F.explode(C.words(F.lower("value"))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query
def row_shaping(spark, folder):
    """map, mapTo, project, discard, rename, insert and filter on one table."""
    rows = read(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    rows = rows.where(F.col("o_totalprice") > 100000).withColumn("thousands", F.floor(F.col("o_totalprice") / 1000))
    rows = rows.drop("o_totalprice").withColumnRenamed("o_orderpriority", "priority").withColumn("source", F.lit("orders"))
    return rows.select("o_orderkey", "priority", "o_orderstatus", "thousands", "source")


@query
def flat_map_rows(spark, folder):
    """flatMap keeps the other fields: the words of part names."""
    parts = read(spark, folder, "part").select("p_partkey", F.explode(C.words("p_name")).alias("word"))
    return parts.groupBy("word").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_part"))


@query
def scalar_functions(spark, folder):
    p = read(spark, folder, "part")
    return p.select(
        "p_partkey", F.lower("p_brand").alias("low"), F.upper("p_name").alias("up"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"),
        F.length("p_name").cast("bigint").alias("len"), C.first_token("p_name").alias("token"),
        F.split("p_brand", "#")[1].cast("bigint").alias("brand_number"), F.col("p_size").cast("string").alias("size_text"),
        C.comma_joined(F.array("p_brand", "p_type")).alias("joined"),
    )


@query
def nested_values(spark, folder):
    """Record field, map value and list element; a missing key or index would fail."""
    p = read(spark, folder, "part")
    nested = p.select(
        "p_partkey", C.record(name="p_name", size="p_size").alias("r"),
        F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type").alias("m"), C.words("p_name").alias("l"),
    )
    return nested.select(
        "p_partkey", F.col("r.name").alias("name"), F.col("r.size").alias("size"),
        C.map_value("m", "brand").alias("brand"), C.list_value("l", 0).alias("head"),
    )


@query
def group_sizes(spark, folder):
    return read(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("size"), F.count("l_shipdate").alias("n"), F.sum("l_quantity").alias("reduced")
    )


@query
def average_all(spark, folder):
    rows = read(spark, folder, "lineitem").agg(F.count("*").alias("size"), F.round(F.avg("l_extendedprice"), 2).alias("average"))
    return rows.withColumn("name", F.lit("AVERAGE"))


@query
def indexed_reduce(spark, folder):
    """Zip with index, then reduce per index: the mean vector of every label."""
    cells = read(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("index", "x"))
    sums = cells.groupBy("label", F.col("index").cast("bigint").alias("index"))
    return sums.agg(F.round(F.sum(F.col("x").cast("double")), 3).alias("total"))


@query
def vector_products(spark, folder):
    v = read(spark, folder, "embeddings")
    twice = C.scaled("embedding", F.lit(2.0))
    return v.select(
        "vec_id", F.round(C.dot("embedding", "embedding"), 4).alias("norm2"),
        F.round(C.dot("embedding", twice), 4).alias("twice"),
    )


@query
def user_fold(spark, folder):
    """A fold without a built-in aggregate: longest distance from the line total = 2000 * quantity."""
    lines = read(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")

    def step(state, batch):
        off = (batch.l_extendedprice - 2000 * batch.l_quantity).abs()
        return (max(state[0], off.max()), state[1] + len(batch)) if len(batch) else state

    return fold_rows(
        lines, ["l_quantity", "l_extendedprice"], lambda: (0.0, 0), step,
        lambda a, b: (max(a[0], b[0]), a[1] + b[1]), lambda s: round(s[0], 2), "farthest",
    )


@query
def pack_unpack(spark, folder):
    rows = read(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    packed = pack(rows, ["c_name", "c_acctbal"], "person").select("c_custkey", "person")
    return unpack(packed, "person", ["name", "balance"]).drop("person")


@query
def writer_schema_projection(spark, folder):
    rows = read(spark, folder, "part").select("p_partkey", F.struct("p_name", "p_size", "p_brand").alias("r"))
    declared = DataType.fromDDL("struct<p_brand:string,p_size:int>")
    kept = rows.select("p_partkey", conform("r", rows.schema["r"].dataType, declared).alias("r"))
    return kept.select("p_partkey", "r.*")


# --- joins and side data (D) ---------------------------------------------------------------------


@query
def join_entity(spark, folder):
    orders = read(spark, folder, "orders").select("o_custkey", "o_totalprice")
    people = scan_cells(customers(spark, folder), "profile:segment").select("custkey", F.col("value").alias("segment"))
    joined = orders.join(people, orders.o_custkey == people.custkey)
    return joined.groupBy("segment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query
def join_composite_entity(spark, folder):
    """Composite ids join on their components: both sides are grouped on those, so the join adds no
    exchange, which a struct key built afterwards would."""
    orders = read(spark, folder, "orders")
    mine = orders.groupBy(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"))
    mine = mine.agg(F.count("*").alias("n"))
    theirs = scan_cells(customers(spark, folder), "spend").withColumnRenamed("qualifier", "priority")
    eid = C.entity_id("custkey", "priority")
    return mine.join(theirs, ["custkey", "priority"]).select(
        C.component(eid, 0).alias("custkey"), C.component(eid, 1).alias("priority"), "n", "value"
    )


@query
def join_hashed_entity(spark, folder):
    orders = read(spark, folder, "orders").groupBy(C.hashed_entity_id("o_custkey").alias("eid")).agg(F.count("*").alias("n"))
    people = read(spark, folder, "customer").select(C.hashed_entity_id("c_custkey").alias("eid"), "c_name")
    return people.join(orders, "eid").select(F.lower(F.hex("eid")).alias("eid"), "c_name", "n")


@query
def entity_order(spark, folder):
    """The least and greatest composite id of every nation, component by component."""
    eid = C.entity_id("c_mktsegment", "c_custkey")
    ends = read(spark, folder, "customer").groupBy("c_nationkey").agg(F.min(eid).alias("lo"), F.max(eid).alias("hi"))
    return ends.select(
        "c_nationkey", *[C.component(e, i).alias(f"{e}{i}") for e in ("lo", "hi") for i in (0, 1)]
    )


@query
def side_lookup(spark, folder):
    nations = read(spark, folder, "nation").select(F.col("n_nationkey").alias("key"), F.struct("n_name", "n_regionkey").alias("value"))
    people = read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    found = lookup(people, nations, "c_nationkey", "nation")
    regions = read(spark, folder, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("value"))
    found = lookup(found, regions, "nation.n_regionkey", "region")
    return found.select("c_custkey", F.col("nation.n_name").alias("nation"), "region")


@query
def side_lookup_table(spark, folder):
    """Side data as large as the entities: not broadcast, heavy keys spread."""
    side = table_column(customers(spark, folder), "profile:acctbal")
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lookup(orders, side, "o_custkey", "acctbal", on_missing="null", small=False)


@query
def side_contains(spark, folder):
    used = read(spark, folder, "supplier").select(F.col("s_nationkey").alias("key"))
    nations = read(spark, folder, "nation").select("n_nationkey", "n_name")
    return contains_key(nations, used, "n_nationkey", "has_supplier")


@query
def group_count_join(spark, folder):
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return join_with_group_count(lines, ["l_suppkey"], "lines_of_supplier")


@query
def total_count_join(spark, folder):
    return join_with_count(read(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), "n")


@query
def cross_one_row(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    top = orders.agg(F.max("o_totalprice").alias("highest"))
    return cross_with_row(orders, top).select("o_orderkey", F.round(F.col("o_totalprice") / F.col("highest"), 6).alias("share"))


# --- item sets (R) ---------------------------------------------------------------------------------


def brand_baskets(spark: SparkSession, folder: str, max_size: int) -> DataFrame:
    """Brands of every order, each at most ``max_size`` times (more cannot appear in a set).

    A basket has at most ``max_size`` times as many items as there are brands."""
    counted = capped_counts(order_brands(spark, folder), ["l_orderkey"], "p_brand", max_size)
    return gather_baskets(counted, ["l_orderkey"], "p_brand", "basket")


@query
def item_pairs(spark, folder):
    pairs = item_sets(brand_baskets(spark, folder, 2), "basket", "pair", 2, 2)
    return pairs.groupBy("pair").agg(F.count("*").alias("n"))


@query
def item_triples(spark, folder):
    triples = item_sets(brand_baskets(spark, folder, 3), "basket", "triple", 3, 3)
    return triples.groupBy("triple").agg(F.count("*").alias("n"))


@query
def item_sets_raw(spark, folder):
    """Pairs of return flag and status of an order's lines, as they are, one row each."""
    lines = read(spark, folder, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("state"))
    counted = capped_counts(lines, ["l_orderkey"], "state", 2)
    return item_sets(gather_baskets(counted, ["l_orderkey"], "state", "basket"), "basket", "pair", 2, 2)


@query
def support_constant(spark, folder):
    pairs = item_sets(brand_baskets(spark, folder, 2), "basket", "pair", 2, 2)
    kept = filter_by_support(pairs, "pair", "support", 0.5, constant=500.0)
    return kept.select("pair", F.col("itemSetFrequency").alias("frequency"), "normalizer", F.round("support", 6).alias("support"))


@query
def support_frame(spark, folder):
    pairs = item_sets(brand_baskets(spark, folder, 2), "basket", "pair", 2, 2)
    total = read(spark, folder, "orders").agg(F.count("*").alias("normalizer"))
    kept = filter_by_support(pairs, "pair", "support", 0.025, normalizer=total)
    return kept.select("pair", F.col("itemSetFrequency").alias("frequency"), "normalizer", F.round("support", 6).alias("support"))


@query
def frequent_itemsets(spark, folder):
    kept = frequent_item_sets(order_brands(spark, folder), ["l_orderkey"], "p_brand", 0.0285, 2, 3)
    return kept.select("itemset", F.col("itemSetFrequency").alias("frequency"), F.round("support", 6).alias("support"))


# --- sinks (K) ---------------------------------------------------------------------------------------


@query
def upsert_latest_write(spark, folder):
    cells = scan_cells(customers(spark, folder), ColumnRequest("spend", max_versions=ALL_VERSIONS))
    return cells.withColumnRenamed("qualifier", "priority")


@query
def cell_log_round_trip(spark, folder):
    """Write mixed columns and a map family, rewrite some cells, and scan the result."""
    log = CellLog(
        spark, f"{shared_folder(spark)}/cells-{uuid.uuid4().hex}", {"custkey": "bigint"},
        {"profile:name": "string", "profile:acctbal": "double", "profile:nation": "int"},
    ).create()
    people = read(spark, folder, "customer").withColumnRenamed("c_custkey", "custkey")
    log.write(people, {"c_name": "profile:name", "c_acctbal": "profile:acctbal", "c_nationkey": "profile:nation"}, version=F.lit(1))
    poor = people.where(F.col("c_acctbal") < 0).withColumn("c_acctbal", F.lit(0.0))
    log.write(poor, {"c_acctbal": "profile:acctbal"}, version=F.lit(1))
    rows = log.scan({c: f"profile:{c}" for c in ("name", "acctbal", "nation")})
    return rows.select("custkey", *[S.first_value(c).alias(c) for c in ("name", "acctbal", "nation")])


# --- files, side data and writes (A15-A21, K2, K3, K7, K9, K11-K13, C4, C11) --------------------------


def scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def text_round_trip(spark, folder):
    """Rows as lines of text and back, with the place of every line in its file.

    A line is ``placed`` if no other begins where it does, and its file begins there or one line of it ends there: lines
    that are all placed fill their files without gaps.
    """
    path = scratch(spark, "text")
    write_text(read(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey"), path)
    end = F.col("offset") + F.octet_length("line") + 1
    edges = placed_lines(spark, path).select("file", F.inline(F.array(
        F.struct(F.col("offset").alias("at"), "line"), F.struct(end.alias("at"), F.lit(None).cast("string").alias("line")))))
    here = Window.partitionBy("file", "at")
    lines = edges.withColumns({"begins": F.count("line").over(here), "meet": F.count("*").over(here)}).where("line IS NOT NULL")
    parts = F.split("line", "\t")
    return lines.select(
        F.get(parts, F.lit(0)).cast("bigint").alias("custkey"), F.get(parts, F.lit(1)).alias("name"),
        F.get(parts, F.lit(2)).cast("int").alias("nation"),
        ((F.col("begins") == 1) & (F.col("meet") == F.when(F.col("at") == 0, 1).otherwise(2))).alias("placed"))


@query
def line_offsets(spark, folder):
    """Lines of a file for each nation, with the place of every line in its file."""
    path = scratch(spark, "lines")
    rows = read(spark, folder, "customer").select(
        F.concat_ws("\t", "c_custkey", "c_name", "c_nationkey").alias("value"), "c_custkey", F.col("c_nationkey").alias("nation"))
    gathered = rows.repartition("nation").sortWithinPartitions("nation", "c_custkey")
    gathered.select("value", "nation").write.partitionBy("nation").text(path)
    lines = text_lines(spark, path, offsets=True)
    return lines.select(F.get(F.split("line", "\t"), F.lit(0)).cast("bigint").alias("custkey"), "offset", "line")


@query
def tsv_round_trip(spark, folder):
    path = scratch(spark, "tsv")
    write_tsv(read(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return spark.read.option("sep", "\t").schema("suppkey bigint, name string, acctbal double").csv(path)


@query
def sequence_round_trip(spark, folder):
    """Order and status as pairs of a sequence file."""
    path = scratch(spark, "pairs")
    pairs = read(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_orderstatus")
    write_sequence_file(pairs, path)
    return sequence_file(spark, path).groupBy(F.col("value").alias("status")).agg(
        F.count("*").alias("n"), F.sum(F.col("key").cast("bigint")).alias("keys"))


@query
def side_key_values(spark, folder):
    path = scratch(spark, "side")
    read(spark, folder, "part").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("value"), "p_type").write.parquet(path)
    rows = read(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    found = lookup(rows, key_values(spark, path), "l_partkey", "brand")
    return found.groupBy("brand").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("orders"))


@query
def side_records(spark, folder):
    """Whole records under a composite key."""
    path = scratch(spark, "records")
    people = read(spark, folder, "customer")
    people.select(F.struct("c_custkey", "c_nationkey").alias("id"), "c_name", "c_acctbal").write.parquet(path)
    rows = people.select("c_custkey", F.struct("c_custkey", "c_nationkey").alias("id"))
    found = lookup(rows, records(spark, path, "id"), "id", "person")
    return found.select("c_custkey", F.col("person.c_name").alias("name"), F.col("person.c_acctbal").alias("acctbal"))


@query
def side_delimited(spark, folder):
    path = scratch(spark, "delimited")
    nations = read(spark, folder, "nation").select(F.concat_ws("=", "n_nationkey", "n_name").alias("value"))
    nations.write.text(path)
    rows = read(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("nation"))
    return lookup(rows, delimited_text(spark, path, "="), "nation", "name").select("s_suppkey", "name")


def activity_pages(spark, folder):
    return scan_pages(activity(spark, folder), ACTIVITY_ALL, page_size=20)


@query
def paged_first_last(spark, folder):
    """First and last cell and statistics of slices that no task holds as a whole."""
    pages = activity_pages(spark, folder)
    first, last = first_of_pages(pages, ["user_id"]), last_of_pages(pages, ["user_id"])
    rows = first.join(last, "user_id").join(page_stats(pages, ["user_id"]), "user_id")
    return rows.select(
        "user_id", F.col("first.qualifier").alias("first_type"), F.col("first.version").alias("first_version"),
        F.col("last.qualifier").alias("last_type"), F.col("last.version").alias("last_version"), "n", F.round("sum", 4).alias("sum"), F.round("variance", 4).alias("variance"))


@query
def paged_groups(spark, folder):
    """Slices by event type, in pieces of a page."""
    groups = group_pages(activity_pages(spark, folder), ["user_id"])
    newest = groups.where("page = 0").select("user_id", "qualifier", F.get("cells", F.lit(0)).version.alias("newest"))
    counts = groups.groupBy("user_id", "qualifier").agg(F.sum(F.size("cells")).cast("bigint").alias("n"))
    return counts.join(newest, ["user_id", "qualifier"]).withColumnRenamed("qualifier", "event_type")


@query
def paged_ordered_fold(spark, folder):
    """How far values move from cell to cell of a slice: a fold in which the order of cells matters."""
    number = lambda c: c.value.cast("double")

    def page_state(cells):
        steps = F.zip_with(F.slice(cells, F.lit(2), F.size(cells)), F.slice(cells, F.lit(1), F.size(cells) - 1), lambda b, a: F.abs(number(b) - number(a)))
        return F.struct(
            number(F.get(cells, F.lit(0))).alias("first"), number(F.element_at(cells, -1)).alias("last"), F.aggregate(steps, F.lit(0.0), lambda t, x: t + x).alias("moved"))

    def merge(a, b):
        return F.struct(a.first.alias("first"), b.last.alias("last"), (a.moved + F.abs(b.first - a.last) + b.moved).alias("moved"))

    return fold_pages(activity_pages(spark, folder), ["user_id"], page_state, merge, "moved", lambda s: F.round(s.moved, 4))


@query
def map_family_write(spark, folder):
    """Order totals into a family by priority, with the order date as version, then compacted."""
    log = CellLog(spark, scratch(spark, "family"), {"custkey": "bigint"}, {"spend": "double"}).create()
    orders = read(spark, folder, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderpriority", "o_totalprice", "o_orderkey", C.micros("o_orderdate").alias("day"))
    for _ in range(2):
        log.write(orders, {"o_totalprice": ColumnOutput("spend", qualifier_field="o_orderpriority")}, version="day", order_by="o_orderkey")
    cells = scan_cells(log.compact(scratch(spark, "family")).table(), ColumnRequest("spend", max_versions=2))
    return cells.withColumnRenamed("qualifier", "priority")


def order_log(spark, folder):
    """Order totals as cells by customer and priority, in ranges of 90 days, and how to write orders there."""
    log = CellLog(spark, scratch(spark, "orders"), {"custkey": "bigint"}, {"spend": "double"}, period=90 * 86_400_000_000).create()
    orders = read(spark, folder, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderpriority", "o_totalprice", "o_orderkey", C.micros("o_orderdate").alias("day"))

    def put(rows):
        log.write(rows, {"o_totalprice": ColumnOutput("spend", qualifier_field="o_orderpriority")}, version="day", order_by="o_orderkey", batch=1)

    return log, orders, put


@query
def colocated_scan(spark, folder):
    """Two newest orders of a priority from a bucketed base: no exchange."""
    log, orders, put = order_log(spark, folder)
    put(orders)
    log.rebase(buckets=8)
    return scan_cells(log.table(), ColumnRequest("spend", max_versions=2)).withColumnRenamed("qualifier", "priority")


@query
def base_and_delta_scan(spark, folder):
    """The same while a third of the orders is a later write: the delta alone is exchanged and merged with the base."""
    log, orders, put = order_log(spark, folder)
    put(orders.where("o_orderkey % 3 > 0"))
    log.rebase(buckets=8)
    put(orders.where("o_orderkey % 3 = 0"))
    return scan_cells(log.table(), ColumnRequest("spend", max_versions=2)).withColumnRenamed("qualifier", "priority")


@query
def log_time_range(spark, folder):
    """Cells of one quarter of a log: other ranges of versions are not opened."""
    log, orders, put = order_log(spark, folder)
    put(orders)
    window = TimeRange.between(day(1995, 2, 1), day(1995, 5, 1))
    return scan_cells(log.table(), ColumnRequest("spend", max_versions=ALL_VERSIONS), window).withColumnRenamed("qualifier", "priority")


@query
def inferred_schema_write(spark, folder):
    """A column without a declared type keeps the record it is given."""
    log = CellLog(spark, scratch(spark, "inferred"), {"suppkey": "bigint"}, {"info:any": None}).create()
    rows = read(spark, folder, "supplier").select(F.col("s_suppkey").alias("suppkey"), F.struct("s_name", "s_acctbal").alias("r"))
    log.write(rows, {"r": "info:any"}, version=F.lit(1))
    found = log.scan({"r": "info:any"}).select("suppkey", S.first_value("r").alias("r"))
    return found.select("suppkey", "r.s_name", "r.s_acctbal")


@query
def nulls_and_empties_write(spark, folder):
    """Empty lists and NULL fields come back as they were; a NULL is no cell of its own type's default."""
    kind = "struct<name:string,words:array<string>>"
    log = CellLog(spark, scratch(spark, "nulls"), {"doc_id": "bigint"}, {"doc:r": kind}).create()
    labels = read(spark, folder, "labels").select("doc_id", "quality", "toxic")
    r = F.struct(F.when(F.col("quality") == 1, "good").alias("name"),
                 F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(F.array().cast("array<string>")).alias("words"))
    log.write(labels.select("doc_id", r.alias("r")), {"r": "doc:r"}, version=F.lit(1))
    found = log.scan({"r": "doc:r"}).select("doc_id", S.first_value("r").alias("r"))
    return found.select("doc_id", "r.name", F.size("r.words").cast("bigint").alias("words"))


@query
def several_outputs(spark, folder):
    """Two results of one parent, which is computed once; both are read back."""
    parent = read(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    sinks = {"many": ParquetFile(scratch(spark, "many")), "few": ParquetFile(scratch(spark, "few"))}
    line = F.col("lines") >= 100
    write_outputs({"many": lambda p: p.where(line), "few": lambda p: p.where(~line)}, sinks, parent)
    parts = [sinks[n].read(spark).withColumn("output", F.lit(n)) for n in ("many", "few")]
    return parts[0].unionByName(parts[1]).withColumn("quantity", F.round("quantity", 2))


@query
def strict_types(spark, folder):
    """Reads that accept exactly the stored types."""
    rows = read(spark, folder, "orders")
    return rows.select(
        require_type(rows, "o_orderkey", "bigint"), require_type(rows, "o_totalprice", "double"), require_type(rows, "o_orderstatus", "string"))


@query
def random_ids(spark, folder):
    """Every imported row gets an id of its own."""
    path = scratch(spark, "ids")
    read(spark, folder, "events").select("event_id").withColumn("eid", C.random_entity_id()).write.parquet(path)
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.countDistinct("eid").alias("ids"))


@query
def slice_function_forms(spark, folder):
    """Statistics of a function of the cells."""
    rows = scan(activity(spark, folder), {"s": ACTIVITY_3})
    double = lambda c: c.value * 2
    forms = {"sum": S.slice_sum, "squares": S.slice_sum_squares, "avg": S.slice_avg, "variance": S.slice_variance,
             "stddev": S.slice_stddev, "least": S.slice_min, "most": S.slice_max}
    return rows.select("user_id", *[F.round(f("s", double), 4).alias(n) for n, f in forms.items()])


@query
def family_default(spark, folder):
    """A whole family with defaults for the documents that lack it."""
    labels = read(spark, folder, "labels").select("doc_id", F.explode(F.array(
        F.struct(F.lit("quality").alias("q"), F.col("quality").alias("v")), F.struct(F.lit("toxic").alias("q"), F.col("toxic").alias("v")))).alias("c"))
    view = LongCells(labels.select("doc_id", "c.*"), "label", {"doc_id": "doc_id"}, "q", Version.number(F.lit(1)), "v")
    request = ColumnRequest("label").replace_missing_with_versioned(("quality", 7, -1), ("toxic", 7, -2))
    rows = scan(CellTable(["doc_id"], [view]), {"labels": request}, universe=read(spark, folder, "documents").select("doc_id"))
    return rows.select("doc_id", F.array_join(F.transform("labels", lambda c: F.concat_ws(":", c.qualifier, c.version, c.value)), ",").alias("labels"))


# --- models (M, U) -----------------------------------------------------------------------------------


@query
def extract_score(spark, folder):
    """Two features from slices and one from side data, scored by a weighted sum."""
    kinds = read(spark, folder, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_regionkey").alias("value"))
    columns = {"nation": "profile:nation", "balance": "profile:acctbal", "spend": ColumnRequest("spend", max_versions=2)}
    extractor = Extractor(
        ["balance", "spend", "region"], ["balance_k", "mean_spend_k", "region_no"],
        lambda b, s, r: (S.first_value(b) / 1000, S.slice_avg(s) / 1000, r.cast("double")),
        [SideLookup("regions", lambda f: S.first_value(f("nation")), "region")],
    )
    scorer = Scorer(["balance_k", "mean_spend_k", "region_no"], lambda b, m, r: F.round(0.7310585786 * b + 0.4401234567 * m + r, 6))
    return score_rows(customers(spark, folder), columns, scorer, extractor, {"regions": kinds}, on_missing="skip")


@query
def score_no_extractor(spark, folder):
    scorer = Scorer(["spend", "custkey"], lambda s, k: F.round(S.slice_max(s) + k, 2))
    return score_rows(customers(spark, folder), {"spend": "spend"}, scorer)


@query
def selector_first(spark, folder):
    scorer = Scorer(ALL, lambda a, b: F.round(a - b, 4))
    columns = {"a": ColumnRequest("activity:view", max_versions=3), "b": ColumnRequest("activity:click", max_versions=3)}
    return score_rows(activity(spark, folder), columns, scorer, first_value_extractor(), on_missing="skip")


@query
def selector_last(spark, folder):
    scorer = Scorer(ALL, lambda a, b: F.round(a - b, 4))
    columns = {"a": ColumnRequest("activity:view", max_versions=3), "b": ColumnRequest("activity:click", max_versions=3)}
    return score_rows(activity(spark, folder), columns, scorer, last_value_extractor(), on_missing="skip")


@query
def selector_all(spark, folder):
    scorer = Scorer("a", lambda a: F.array_join(F.transform(a, lambda x: cents(x).cast("string")), ","))
    columns = {"a": ColumnRequest("activity:view", max_versions=3)}
    return score_rows(activity(spark, folder), columns, scorer, slice_extractor(), on_missing="skip")


@query
def evaluate_distance(spark, folder):
    """Mean and greatest distance between the newest view and click of a user."""
    rows = scan(activity(spark, folder), {"a": "activity:view", "b": "activity:click"})
    rows = rows.select("user_id", S.first_value("a").alias("a"), S.first_value("b").alias("b"))
    distance = Distance(["a", "b"], "distance", lambda a, b: F.abs(a - b))
    total = {"mean": F.round(F.avg("distance"), 6), "worst": F.round(F.max("distance"), 4), "n": F.count("*")}
    return evaluate_rows(rows, Evaluator(distance, total))


@query
def evaluate_rows_only(spark, folder):
    rows = scan(customers(spark, folder), {"a": "spend:1-URGENT", "b": "spend:5-LOW"})
    rows = rows.select("custkey", S.first_value("a").alias("a"), S.first_value("b").alias("b"))
    distance = Distance(["a", "b"], ["apart", "ratio"], lambda a, b: (F.round(F.abs(a - b), 2), F.round(a / b, 6)))
    return evaluate_rows(rows, Evaluator(distance)).select("custkey", "apart", "ratio")


@query
def prepare_train_score(spark, folder):
    """The life cycle over written tables: spend per customer, its mean, and the ratio of the two."""
    base = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    log = CellLog(spark, f"{base}/spend", {"custkey": "bigint"}, {"m:total": "double", "m:mean": "double", "m:score": "double"}).create()

    def prepare(inputs, context):
        totals = inputs["orders"].groupBy(F.col("o_custkey").alias("custkey")).agg(F.sum("o_totalprice").alias("total"))
        return {"total": totals}

    def train(inputs, context):
        mean = inputs["totals"].agg(F.avg(S.first_value("total")).alias("mean"))
        return {"mean": mean.select(F.lit(-1).cast("bigint").alias("custkey"), "mean")}

    orders = read(spark, folder, "orders").select("o_custkey", "o_totalprice")
    model = Model(
        prepare, train,
        Extractor(
            ["total", "mean"], ["ratio"], lambda t, m: [S.first_value(t) / m],
            [SideLookup("mean", F.lit(-1).cast("bigint"), "mean")],
        ),
        Scorer("ratio", lambda r: r),
    )
    environment = Environment(
        PhaseEnvironment({"orders": orders}, {"total": CellColumns(log, {"total": "m:total"})}),
        PhaseEnvironment({"totals": CellColumns(log, {"total": "m:total"})}, {"mean": CellColumns(log, {"mean": "m:mean"})}),
        ScoreEnvironment(
            log, {"total": "m:total"}, CellColumns(log, {"score": "m:score"}),
            {"mean": lambda: table_column(log.table(), "m:mean")}, on_missing="skip",
        ),
    )
    run_model(spark, model, environment)
    scores = log.scan({"score": "m:score"})
    return scores.select("custkey", F.round(S.first_value("score"), 6).alias("score"))


def scaled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity, discount and price in units near one. Quantities run from 1 to 50."""
    lines = read(spark, folder, "lineitem")
    return lines.select(
        ((F.col("l_quantity") - 25.5) / 14.43).alias("quantity"), ((F.col("l_discount") - 0.05) / 0.03).alias("discount"),
        (F.col("l_extendedprice") / 10000).alias("price"), F.col("l_shipdate").alias("shipped"),
    )


@query
def lm_one_step(spark, folder):
    """One step from theta = 0 at the default rate."""
    fitted = train_linear(scaled_lines(spark, folder), ["quantity"], "price", max_iterations=1)
    return fitted.select(
        F.col("index").cast("bigint").alias("index"), F.round("theta", 2).alias("theta"), F.round("gradient", 2).alias("gradient")
    )


@query
def lm_converged(spark, folder):
    rate = F.lit(0.5) / F.count("*")
    fitted = train_linear(scaled_lines(spark, folder), ["quantity"], "price", learning_rate=rate)
    return fitted.select(F.col("index").cast("bigint").alias("index"), F.round("theta", 4).alias("theta"))


@query
def lm_wide(spark, folder):
    """One step on a feature for each day of the month and each discount: too many for sums as columns."""
    lines = scaled_lines(spark, folder)
    days = [F.when(F.dayofmonth("shipped") == d, 1.0).otherwise(0.0) for d in range(1, 32)]
    fitted = train_linear(lines, [*days, "quantity"], "price", learning_rate=0.001, max_iterations=1)
    return fitted.select(F.col("index").cast("bigint").alias("index"), F.round("theta", 4).alias("theta"), F.col("iterations").cast("bigint").alias("iterations"))


@query
def lm_two_features(spark, folder):
    rate = F.lit(0.5) / F.count("*")
    fitted = train_linear(scaled_lines(spark, folder), ["quantity", "discount"], "price", learning_rate=rate)
    return fitted.select(F.col("index").cast("bigint").alias("index"), F.round("theta", 4).alias("theta"))
