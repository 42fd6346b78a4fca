"""Plan shapes of the whole catalogue."""

import re

import pytest

from cellflow.plans.catalogue import QUERIES, customers
from cellflow.sources.cells import CellTable, Version, WideCells
from cellflow.sources.requests import ColumnRequest, TimeRange
from cellflow.sources.scan import scan, scan_cells
from tests.helpers import plan

EXCHANGES = {  # queries whose number of exchanges is a design decision
    "latest_cell_family": 1, "latest_n_versions": 1, "entities_scan": 1, "wide_time_range": 0,
    "multi_column_profile": 0, "reader_projection": 0, "slice_stats": 2, "slice_first_last": 2,
    "word_count": 1, "row_shaping": 0, "vector_products": 0,
    "upsert_latest_write": 1, "evaluate_rows_only": 1, "lm_converged": 1, "selector_first": 1,
}
WRITES = {  # what is read back from files of their own
    "cell_log_round_trip", "prepare_train_score", "text_round_trip", "tsv_round_trip", "sequence_round_trip", "scan_counters", "random_ids",
    "map_family_write", "line_offsets", "colocated_scan", "base_and_delta_scan", "log_time_range", "inferred_schema_write", "nulls_and_empties_write", "several_outputs",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    if name in ("user_fold", "lm_wide"):  # user functions and matrices; merged states meet in the last task
        return
    assert "Python" not in text and "InPandas" not in text
    if name in EXCHANGES:
        assert len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", text)) == EXCHANGES[name]
    # Only counts, sums and the like may meet in one task.
    for parent in re.findall(r"Exchange SinglePartition.*\n[^A-Za-z]*(?:\*\(\d+\) )?(\w+)", text):
        assert "Aggregate" in parent, parent


def test_newest_versions_are_cut_before_anything_moves(spark, sf):
    text = plan(QUERIES["latest_n_versions"](spark, sf))
    assert re.findall(r"Exchange|MapInArrow", text) == ["Exchange", "MapInArrow"]


def test_wide_views_push_their_conditions(spark, sf):
    view = WideCells(
        spark.read.parquet(f"{sf}/orders.parquet"), "order", {"orderkey": "o_orderkey"}, {"price": "o_totalprice", "status": "o_orderstatus"},
        Version.micros_of("o_orderdate"))
    table, late = CellTable(["orderkey"], [view]), TimeRange.after(820454400000000)
    for frame in (scan(table, {"p": "order:price"}, late), scan_cells(table, ColumnRequest("order:price"), late)):
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan(frame))[1]
        assert "GreaterThanOrEqual(o_orderdate" in pushed and "IsNotNull(o_totalprice)" in pushed
        assert "Generate" not in plan(frame)
    assert "o_orderdate" in plan(scan_cells(table, "order", late)) and "Generate" in plan(scan_cells(table, "order", late))
    assert scan(customers(spark, sf), {"n": "profile:name"}).count() > 0


def test_small_side_data_costs_no_exchange_of_rows_and_no_job(spark, sf):
    """The entities are scanned once, and the plan of a score is made without running anything."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job is expected")
    try:
        frame = QUERIES["extract_score"](spark, sf)
        assert len(tracker.getJobIdsForGroup("planning")) <= 3  # the schemas of three files
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = plan(frame)
    assert text.count("FileScan") == 3  # customers, orders, nations
    assert "approx_top_k" not in text and "BroadcastHashJoin" in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 3  # spend by customer, customers to meet it, keys of the side data
    assert sum("Exchange hashpartitioning(custkey" in line for line in text.splitlines()) == 1
    wide = plan(QUERIES["side_lookup_table"](spark, sf))
    assert "approx_top_k" in wide
