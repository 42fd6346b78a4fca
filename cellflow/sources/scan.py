"""Scans of cell tables: slices per entity, long cells, or bounded pages of cells."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflow.functions import as_column, literal_of, orderable
from cellflow.operators.versions import latest_versions
from cellflow.session import shared_folder
from cellflow.sources.cells import CellTable, LongCells, WideCells, narrowed
from cellflow.sources.requests import ALL_TIME, Cell, ColumnRequest, DataRequest, TimeRange, as_request

Columns = Mapping[str, "str | ColumnRequest"]


def scan(
    table: CellTable,
    columns: Columns | DataRequest,
    time_range: TimeRange = ALL_TIME,
    universe: DataFrame | None = None,
    counters: Observation | None = None,
    keep_missing: bool = False,
    max_cells: int | None = None,
) -> DataFrame:
    """One row per entity with one slice per field.

    A slice is ``ARRAY<STRUCT<qualifier, version, value>>`` ordered by qualifier, newest first.
    Entities lacking a column without a default are dropped, unless ``keep_missing`` leaves NULL.
    ``universe`` lists the entities to return when every column has a default; by default those with
    at least one requested cell. ``counters`` observes ``rows_read`` and ``rows_skipped`` (A10).

    A slice is one value of one row, so use it for bounded slices. For whole histories aggregate
    ``scan_cells`` instead, or ask for pages. With ``max_cells`` the cells per entity are counted
    first, and the scan fails before it gathers a slice larger than that.
    """
    if isinstance(columns, DataRequest):
        columns, time_range = columns.columns, columns.time_range
    requests = {field: as_request(c) for field, c in columns.items()}
    clash = sorted(set(requests) & set(table.entity))
    if clash:
        raise ValueError(f"fields named like the entity columns: {', '.join(clash)}")
    table.validate(list(requests.values()))
    if not requests:
        return table.entities()
    paged = [f for f, r in requests.items() if r.page_size is not None]
    if len(paged) > 1:
        raise ValueError(f"a scan can page one column, not {', '.join(paged)}")
    if paged:
        if counters is not None or keep_missing:
            raise ValueError("a scan with pages drops entities without counting them")
        return _scan_with_pages(table, requests, paged[0], time_range, universe)

    required = [f for f, r in requests.items() if r.default is None]
    outer = counters is not None or keep_missing
    joined = _join_frames(table, requests, time_range, universe, outer, max_cells)
    missing = reduce(or_, [F.col(f).isNull() for f in required], F.lit(False))
    if counters is not None:
        joined = joined.observe(
            counters,
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(missing).alias("rows_skipped"),
        )
    if required and not keep_missing:
        joined = joined.where(~missing)
    out = []
    for field, request in requests.items():
        slot = F.col(field)
        if request.default is not None:
            slot = F.coalesce(slot, _default_slice(request, joined.schema[field].dataType))
        out.append(slot.alias(field))
    return joined.select(*table.entity, *out)


def skipped_entities(
    table: CellTable, columns: Columns, time_range: TimeRange = ALL_TIME, every: int = 1
) -> DataFrame:
    """Entities a scan drops for a missing column; ``every`` thins them as the skip log does (A10)."""
    requests = {field: as_request(c) for field, c in columns.items()}
    rows = scan(table, columns, time_range, keep_missing=True)
    missing = [f for f, r in requests.items() if r.default is None]
    names = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(requests[f].name)) for f in missing]))
    skipped = rows.select(*table.entity, names.alias("missing")).where(F.size("missing") > 0)
    if every > 1:
        # By the entity and not by its place, so that the partitioning does not matter.
        skipped = skipped.where(F.pmod(F.xxhash64(*table.entity), F.lit(every)) == 0)
    return skipped


def scan_cells(table: CellTable, column: str | ColumnRequest, time_range: TimeRange = ALL_TIME) -> DataFrame:
    """Long rows (entity, qualifier, version, value) of one request, never gathered.

    This is the form to aggregate: a hot entity stays spread over its rows.
    """
    request = as_request(column)
    table.validate([request])
    view = table.find(request)
    if isinstance(view, WideCells):
        frame = _wide_rows(view, [request], time_range)
        if request.qualifier is not None:
            value = narrowed(as_column(view.columns[request.qualifier]), request)
            if request.filter is not None:
                frame = frame.where(request.filter.condition(F.lit(request.qualifier)))
            rows = frame.select(
                *_entity(view), F.lit(request.qualifier).alias("qualifier"), view.version.value.alias("version"), value.alias("value"))
        else:
            cells = F.explode(_wide_slice(view, request, time_range)).alias("c")
            rows = frame.select(*_entity(view), cells).select(*table.entity, "c.*")
    else:
        rows = _long_cells(view, request, time_range)
    return rows.select(*table.entity, "qualifier", "version", "value")


def scan_pages(
    table: CellTable, column: str | ColumnRequest, page_size: int | None = None, time_range: TimeRange = ALL_TIME
) -> DataFrame:
    """Slices cut into full pages of ``page_size`` cells, the last one shorter: (entity, page, cells).

    Pages of one entity, numbered from 0, give its slice in canonical order; the partitioning does not matter. The cells are
    ranged on their whole address and written once, so the pages of a hot entity are built by many tasks: a cell's
    position is its place in its part of the range, plus the cells of the entity in earlier parts.
    """
    request = as_request(column)
    size = request.page_size if page_size is None else page_size
    if size is None or size < 1:
        raise ValueError(f"{request.name}: a page size of at least 1 is needed")
    cells = scan_cells(table, request, time_range)
    spark = cells.sparkSession
    address = [*[F.col(e) for e in table.entity], F.col("qualifier"), F.col("version").desc()]
    ranged = cells.repartitionByRange(*address).sortWithinPartitions(*address)
    # The ids of a part rise with the address; parts themselves are numbered in the order of the range.
    ranged = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    path = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    ranged.write.parquet(path)
    written = spark.read.schema(ranged.schema).parquet(path)
    parts = written.groupBy(*table.entity, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*table.entity).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    placed = written.join(parts.select(*table.entity, "_part", "_first", "_before"), [*table.entity, "_part"])
    placed = placed.withColumn("page", F.expr(f"(_before + _at - _first) div {int(size)}"))
    pages = placed.groupBy(*table.entity, "page").agg(F.collect_list(_sortable()).alias("_cells"))
    return pages.select(*table.entity, "page", _canonical(pages, "_cells").alias("cells"))


# --- building blocks -------------------------------------------------------------------------


def _entity(view: LongCells | WideCells) -> list[Column]:
    return [as_column(c).alias(n) for n, c in view.entity.items()]


def _long_cells(view: LongCells, request: ColumnRequest, time_range: TimeRange, by: list[str] | None = None) -> DataFrame:
    rows = view.rows(request, time_range)
    order = None if view.write_order is None else "_order"
    keys = list(view.entity)
    if request.qualifier is None:
        return latest_versions(rows, [*keys, "qualifier"], request.max_versions, order, by, view.colocated)
    # One qualifier only: leave it out of the keys, so that grouping by entity needs no new exchange.
    cells = latest_versions(rows.drop("qualifier"), keys, request.max_versions, order, colocated=view.colocated)
    return cells.withColumn("qualifier", F.lit(request.qualifier))


def _sortable() -> Column:
    # Bitwise complement reverses the order of versions without overflow.
    return F.struct("qualifier", F.bitwise_not("version").alias("newest_first"), "value")


def _canonical(frame: DataFrame, column: str) -> Column:
    """Cells ordered by qualifier, newest version first (O1)."""
    value_type = frame.schema[column].dataType.elementType["value"].dataType
    if orderable(value_type):
        ordered = F.sort_array(column)
    else:
        ordered = F.array_sort(
            column,
            lambda a, b: F.when(
                F.struct(a.qualifier, a.newest_first) < F.struct(b.qualifier, b.newest_first), -1
            ).otherwise(1),
        )
    return F.transform(
        ordered,
        lambda c: F.struct(
            c.qualifier.alias("qualifier"), F.bitwise_not(c.newest_first).alias("version"), c.value.alias("value")
        ),
    )


def _wide_slice(view: WideCells, request: ColumnRequest, time_range: TimeRange) -> Column:
    names = [request.qualifier] if request.qualifier is not None else sorted(view.columns)
    inside = view.version.within(time_range)
    cells = []
    for name in names:
        value = as_column(view.columns[name])
        present = value.isNotNull() if inside is None else value.isNotNull() & inside
        if request.filter is not None:
            present = present & request.filter.condition(F.lit(name))
        cell = F.struct(
            F.lit(name).alias("qualifier"),
            view.version.value.alias("version"),
            narrowed(value, request).alias("value"),
        )
        cells.append(F.when(present, cell))
    if len(cells) == 1:
        return F.when(cells[0].isNotNull(), F.array(cells[0]))
    slots = F.array_compact(F.array(*cells))
    return F.when(F.size(slots) > 0, slots)


def _wide_rows(view: WideCells, requests: list[ColumnRequest], time_range: TimeRange) -> DataFrame:
    """Rows with a wanted cell in the time range, as plain conditions that reach the files."""
    frame = view.frame
    inside = view.version.within(time_range)
    if inside is not None:
        frame = frame.where(inside)
    names = {n for r in requests for n in ([r.qualifier] if r.qualifier is not None else view.columns)}
    return frame.where(reduce(or_, [as_column(view.columns[n]).isNotNull() for n in sorted(names)]))


def _wide_frame(view: WideCells, requests: Mapping[str, ColumnRequest], time_range: TimeRange) -> DataFrame:
    """All requests on a wide view: a projection, no exchange. Rows without any wanted cell are left out."""
    return _wide_rows(view, list(requests.values()), time_range).select(
        *_entity(view), *[_wide_slice(view, r, time_range).alias(f) for f, r in requests.items()]
    )


def _newest_frame(view: LongCells, requests: Mapping[str, ColumnRequest], time_range: TimeRange) -> DataFrame:
    """Newest cell of several single columns of one family: one scan and one exchange for all."""
    family = ColumnRequest(view.family)
    rows = view.rows(family, time_range)
    rows = rows.where(F.col("qualifier").isin(sorted({r.qualifier for r in requests.values()})))
    rank = F.col("version") if view.write_order is None else F.struct("version", "_order")
    aggregates = []
    for field, request in requests.items():
        mine = request.wants(F.col("qualifier"))
        aggregates.append(F.max(F.when(mine, F.col("version"))).alias(f"{field} version"))
        value = F.when(mine, narrowed(F.col("value"), request))
        aggregates.append(F.max_by(value, F.when(mine, rank)).alias(f"{field} value"))
    newest = rows.groupBy(*view.entity).agg(*aggregates)
    slots = [
        F.when(
            F.col(f"`{field} version`").isNotNull(),
            F.array(
                F.struct(
                    F.lit(request.qualifier).alias("qualifier"),
                    F.col(f"`{field} version`").alias("version"),
                    F.col(f"`{field} value`").alias("value"),
                )
            ),
        ).alias(field)
        for field, request in requests.items()
    ]
    return newest.select(*view.entity, *slots)


def _several_frame(
    view: LongCells,
    requests: Mapping[str, ColumnRequest],
    max_versions: int | None,
    time_range: TimeRange,
    max_cells: int | None,
) -> DataFrame:
    """Several single columns of one family with the same number of versions: one scan for all."""
    rows = view.rows(ColumnRequest(view.family), time_range)
    rows = rows.where(F.col("qualifier").isin(sorted({r.qualifier for r in requests.values()})))
    order = None if view.write_order is None else "_order"
    cells = latest_versions(rows, [*view.entity, "qualifier"], max_versions, order, list(view.entity), view.colocated)
    cells = _no_larger(cells, list(view.entity), max_cells)
    cells = cells.withColumn("newest_first", F.bitwise_not("version"))
    # collect_list leaves out the NULLs of the other columns' cells.
    lists = []
    for field, request in requests.items():
        cell = F.struct("qualifier", "newest_first", narrowed(F.col("value"), request).alias("value"))
        lists.append(F.collect_list(F.when(request.wants(F.col("qualifier")), cell)).alias(field))
    gathered = cells.groupBy(*view.entity).agg(*lists)
    slots = [F.when(F.size(f) > 0, _canonical(gathered, f)).alias(f) for f in requests]
    return gathered.select(*view.entity, *slots)


def _no_larger(cells: DataFrame, entity: list[str], max_cells: int | None) -> DataFrame:
    if max_cells is None:
        return cells
    # A scalar is known before the stage that gathers starts.
    largest = cells.groupBy(*entity).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    message = F.lit(f"a slice has more than {max_cells} cells: aggregate long cells, or scan pages")
    return cells.where(F.when(largest > max_cells, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def _slice_frame(
    view: LongCells, field: str, request: ColumnRequest, time_range: TimeRange, max_cells: int | None
) -> DataFrame:
    cells = _no_larger(_long_cells(view, request, time_range, list(view.entity)), list(view.entity), max_cells)
    gathered = cells.groupBy(*view.entity).agg(F.collect_list(_sortable()).alias(field))
    return gathered.select(*view.entity, _canonical(gathered, field).alias(field))


def _frames(
    table: CellTable, requests: Mapping[str, ColumnRequest], time_range: TimeRange, max_cells: int | None
) -> list[tuple[list[str], DataFrame]]:
    by_view: dict[int, tuple[LongCells | WideCells, dict[str, ColumnRequest]]] = {}
    for field, request in requests.items():
        view = table.find(request)
        by_view.setdefault(id(view), (view, {}))[1][field] = request
    frames = []
    for view, mine in by_view.values():
        if isinstance(view, WideCells):
            frames.append((list(mine), _wide_frame(view, mine, time_range)))
            continue
        by_limit: dict[int | None, dict[str, ColumnRequest]] = {}
        for field, request in mine.items():
            if request.qualifier is None:
                frames.append(([field], _slice_frame(view, field, request, time_range, max_cells)))
            else:
                by_limit.setdefault(request.max_versions, {})[field] = request
        for limit, singles in by_limit.items():
            if limit == 1:
                frame = _newest_frame(view, singles, time_range)
            elif len(singles) > 1:
                frame = _several_frame(view, singles, limit, time_range, max_cells)
            else:
                ((field, request),) = singles.items()
                frame = _slice_frame(view, field, request, time_range, max_cells)
            frames.append((list(singles), frame))
    return frames


def _join_frames(
    table: CellTable,
    requests: Mapping[str, ColumnRequest],
    time_range: TimeRange,
    universe: DataFrame | None,
    outer: bool,
    max_cells: int | None,
) -> DataFrame:
    """Join frames on the entity. Each has one row per entity, so no join key is repeated, and a frame
    that comes from a grouping is already partitioned by it: only wide views may be exchanged here."""
    entity = table.entity
    frames = _frames(table, requests, time_range, max_cells)
    if universe is not None:
        out = universe.select(*entity).distinct()
        for _, frame in frames:
            out = out.join(frame, entity, "left")
        return out
    tight, loose = [], []
    for fields, frame in frames:
        needed = [f for f in fields if requests[f].default is None]
        if needed and not outer:
            tight.append(frame.where(reduce(and_, [F.col(f).isNotNull() for f in needed])))
        else:
            loose.append(frame.where(reduce(or_, [F.col(f).isNotNull() for f in fields])))
    ordered = tight + loose
    how_rest = "left" if tight else "full"
    out = ordered[0]
    for i, frame in enumerate(ordered[1:], 1):
        out = out.join(frame, entity, "inner" if i < len(tight) else how_rest)
    return out


def _default_slice(request: ColumnRequest, slice_type: T.ArrayType) -> Column:
    def literal(cell: Cell) -> Column:
        return F.struct(
            F.lit(cell.qualifier or request.qualifier).alias("qualifier"),
            F.lit(cell.version).cast("bigint").alias("version"),
            literal_of(cell.value, value_type).alias("value"),
        )

    value_type = slice_type.elementType["value"].dataType
    cells = sorted(request.default, key=lambda c: (c.qualifier or request.qualifier, -c.version))
    return F.array(*[literal(c) for c in cells]).cast(slice_type)


def _scan_with_pages(
    table: CellTable,
    requests: Mapping[str, ColumnRequest],
    field: str,
    time_range: TimeRange,
    universe: DataFrame | None,
) -> DataFrame:
    """One row per page of ``field``, the other slices repeated; ``<field>_page`` orders them."""
    from cellflow.operators.joins import skewed_join

    request = requests[field]
    others = {f: r for f, r in requests.items() if f != field}
    pages = scan_pages(table, request, time_range=time_range).select(
        *table.entity, F.col("page").alias(f"{field}_page"), F.col("cells").alias(field)
    )
    if request.default is not None:
        default = _default_slice(request, pages.schema[field].dataType)
        if not others and universe is None:
            return pages
        base = scan(table, others, time_range, universe) if others else universe.select(*table.entity).distinct()
        # Entities without a page get the default slice as their only page.
        bare = base.join(pages.select(*table.entity).distinct(), table.entity, "left_anti")
        bare = bare.withColumn(f"{field}_page", F.lit(0).cast("bigint")).withColumn(field, default)
        full = skewed_join(pages, base, table.entity)
        return full.unionByName(bare)
    if not others:
        return pages
    return skewed_join(pages, scan(table, others, time_range, universe), table.entity)
