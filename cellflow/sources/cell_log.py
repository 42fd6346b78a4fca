"""Writable cell tables: an append-only Parquet log of cells, resolved when read."""

from __future__ import annotations

import copy
import re
import time
import uuid
import zlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflow.functions import as_column, orderable
from cellflow.operators.nested import SchemaMismatch, conform
from cellflow.session import shared_folder
from cellflow.sources.cells import CellTable, LongCells, Version
from cellflow.sources.requests import ALL_TIME, ColumnRequest, DataRequest, TimeRange
from cellflow.sources.scan import scan


#: How files are laid out: by column, range of versions, and write; a base is made of many writes.
BASE_PARTITIONS = ("column", "low", "high")
PARTITIONS = (*BASE_PARTITIONS, "delta")
MANIFEST = "number bigint, base string, buckets int, merged array<string>"


class InvalidWrite(ValueError):
    """Every fault of a write, in one message, before any job starts."""


@dataclass(frozen=True)
class ColumnLayout:
    """``type`` is the declared value type (the default schema). Without one, values are stored with
    the schema they have (K7), unless ``validated`` asks every write to name its schema (K8)."""

    type: str | None = None
    validated: bool = False

    @property
    def data_type(self) -> T.DataType | None:
        return None if self.type is None else T.DataType.fromDDL(self.type)


@dataclass(frozen=True)
class ColumnOutput:
    """A target column: ``"family:qualifier"``, or a family with the field holding the qualifier
    (K2). ``schema`` is a registered writer schema to conform to."""

    name: str
    qualifier_field: str | None = None
    schema: str | None = None


class CellLog:
    """A cell table that can be written.

    Declared columns share one Parquet table, partitioned by column, with one value field per type:
    a write of any number of columns is a single job, and a read touches the partitions and the value
    field of the requested columns only. Columns without a declared type have a table of their own.
    Nothing is updated in place: of several rows for one cell the last write counts (K5).

    ``period`` is a number of versions: cells are stored apart by ranges of so many, and a read with a time range opens the
    files of the ranges it meets only.

    ``rebase`` merges the cells into a base that is bucketed and sorted by entity, so that a scan of it exchanges nothing; later
    writes are deltas, and a read exchanges those alone and merges them with the base by entity. Which base and which deltas make up
    the table is told by a manifest, of which one file more is written when all else is done: a reader sees the one or the other.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        entity: Mapping[str, str],
        columns: Mapping[str, str | ColumnLayout],
        period: int | None = None,
    ):
        if period is not None and period < 1:
            raise ValueError("a period has at least one version")
        self.spark, self.path, self.period = spark, path, period
        self.entity = {n: T.DataType.fromDDL(t) for n, t in entity.items()}
        self.columns = {n: c if isinstance(c, ColumnLayout) else ColumnLayout(c) for n, c in columns.items()}
        types = {c.data_type.simpleString(): c.data_type for c in self.columns.values() if c.type is not None}
        # Named after the type alone: a column added to the layout later leaves stored data readable.
        self._slots = {name: (_slot_name(name), types[name]) for name in sorted(types)}

    # --- layout ---

    def _slot(self, layout: ColumnLayout) -> str:
        return self._slots[layout.data_type.simpleString()][0]

    def _schema(self) -> T.StructType:
        head = [T.StructField(n, t) for n, t in self.entity.items()]
        middle = [T.StructField("qualifier", T.StringType())]
        middle += [T.StructField(n, T.LongType()) for n in ("version", "batch", "seq")]
        slots = [T.StructField(n, t) for n, t in self._slots.values()]
        parts = [T.StructField(n, T.LongType() if n in ("low", "high") else T.StringType()) for n in PARTITIONS]
        return T.StructType([*head, *middle, *slots, *parts])

    def _ranged(self, rows: DataFrame) -> DataFrame:
        """Rows with the range of versions they are stored under."""
        if self.period is None:
            return rows.withColumn("low", F.lit(-(1 << 63))).withColumn("high", F.lit((1 << 63) - 1))
        size = F.lit(self.period).cast("bigint")
        # a range that would leave the numbers ends with them
        low = F.coalesce(F.try_subtract("version", F.pmod("version", size)), F.lit(-(1 << 63)))
        return rows.withColumn("low", low).withColumn("high", F.coalesce(F.try_add("low", size), F.lit((1 << 63) - 1)))

    def _append(self, rows: DataFrame, path: str) -> None:
        """One more delta: rows gathered by column first, so that many small tasks do not leave a file each in every column (adaptive
        execution cuts large columns into several tasks), and sorted, which keeps the row-group statistics narrow."""
        named = self._ranged(rows).withColumn("delta", F.lit(f"d{uuid.uuid4().hex}"))
        gathered = named.select(*[f.name for f in self._schema().fields]).hint("rebalance", "column", "low")
        ordered = gathered.sortWithinPartitions(*PARTITIONS, *self.entity, "version")
        ordered.write.mode("append").partitionBy(*PARTITIONS).parquet(f"{path}/cells")

    def _own_path(self, column: str) -> str:
        return f"{self.path}/own/{column.replace(':', '.')}"

    def create(self) -> CellLog:
        """Lay out an empty table, so that it can be read before the first write."""
        empty = self.spark.createDataFrame([], self._schema())
        empty.write.mode("append").partitionBy(*PARTITIONS).parquet(f"{self.path}/cells")
        return self

    # --- writing ---

    def write(
        self,
        rows: DataFrame,
        outputs: Mapping[str, str | ColumnOutput],
        version: str | Column | None = None,
        order_by: str | Column | None = None,
        batch: int | None = None,
    ) -> None:
        """Append one cell per row and output field (K1-K4, K6, K7, K9).

        All cells of a row get the same version: the given one, else the current time in
        milliseconds. Two rows for one cell in one write need ``order_by`` (a BIGINT) to say which is
        the later one; without it the greater value counts, so that every read agrees. ``batch``
        ranks writes; by default the clock does.
        """
        targets = {f: o if isinstance(o, ColumnOutput) else ColumnOutput(o) for f, o in outputs.items()}
        if version is None:
            stamp = F.unix_millis(F.current_timestamp())
        else:
            stamp = as_column(version).cast("bigint")
        values = self._checked(rows, targets)
        batch_number = F.lit(time.time_ns() if batch is None else batch).cast("bigint")
        order = F.lit(0) if order_by is None else as_column(order_by)
        head = [*self.entity, stamp.alias("version"), batch_number.alias("batch"), order.cast("bigint").alias("seq")]

        declared = {f: o for f, o in targets.items() if self.columns[o.name].type is not None}
        if declared:
            cells = F.array(*[self._cell(o, values[f]) for f, o in declared.items()])
            long = rows.select(*head, F.inline(cells))
            self._append(long, self.path)
        for field, output in targets.items():
            if field not in declared:
                own = rows.select(*head, self._qualifier(output).alias("qualifier"), values[field].alias("value"))
                own.write.mode("append").parquet(self._own_path(output.name))

    def _qualifier(self, output: ColumnOutput) -> Column:
        if output.qualifier_field is not None:
            return F.col(output.qualifier_field).cast("string")
        return F.lit(output.name.partition(":")[2])

    def _cell(self, output: ColumnOutput, value: Column) -> Column:
        mine = self._slot(self.columns[output.name])
        slots = [
            (value if name == mine else F.lit(None).cast(dtype)).alias(name) for name, dtype in self._slots.values()
        ]
        return F.struct(F.lit(output.name).alias("column"), self._qualifier(output).alias("qualifier"), *slots)

    def _checked(self, rows: DataFrame, targets: Mapping[str, ColumnOutput]) -> dict[str, Column]:
        faults, values = [], {}
        faults += [f"no entity column {e}" for e in self.entity if e not in rows.columns]
        for field, output in targets.items():
            layout = self.columns.get(output.name)
            is_family = ":" not in output.name
            if layout is None:
                faults.append(f"the table has no column {output.name}")
            elif field not in rows.columns:
                faults.append(f"no field {field} for {output.name}")
            elif is_family != (output.qualifier_field is not None):
                faults.append(f"{output.name}: a qualifier field goes with a family, and only with one")
            elif is_family and output.qualifier_field not in rows.columns:
                faults.append(f"no field {output.qualifier_field} for the qualifiers of {output.name}")
            elif layout.validated and layout.type is None and output.schema is None:
                faults.append(f"{output.name} is validated: name the schema to write")
            else:
                try:
                    values[field] = self._conformed(rows, field, output, layout)
                except SchemaMismatch as fault:
                    faults.append(str(fault))
        if faults:
            raise InvalidWrite("; ".join(faults))
        return values

    def _conformed(self, rows: DataFrame, field: str, output: ColumnOutput, layout: ColumnLayout) -> Column:
        value, dtype = F.col(field), rows.schema[field].dataType
        if output.schema is not None:
            registered = T.DataType.fromDDL(output.schema)
            value, dtype = conform(value, dtype, registered, output.name), registered
        if layout.type is not None:
            value = conform(value, dtype, layout.data_type, output.name)
        return value

    def compact(self, path: str) -> CellLog:
        """Write the last write of every cell to a new path: the next generation of this table, for the caller to go on with (K5).

        Earlier writes of a cell combine before the exchange. Reads of both generations are equal.
        """
        out = copy.copy(self)
        out.path = path
        out.create()
        self._append(self._last_writes(self._cells()[0]), path)
        for name, layout in self.columns.items():
            if layout.type is None and (views := self._own_views(name, *name.partition(":")[::2], {})):
                own = views[0].frame
                rest = [c for c in own.columns if c not in (*self.entity, "qualifier", "version")]
                last = own.groupBy(*self.entity, "qualifier", "version").agg(
                    F.max_by(F.struct(*rest), _write_order("value", own.schema["value"].dataType)).alias("_last"))
                last.select("*", "_last.*").select(*own.columns).write.mode("append").parquet(out._own_path(name))
        return out

    def _last_writes(self, cells: DataFrame) -> DataFrame:
        """One row for every cell. Earlier writes of a cell combine before the exchange."""
        stored = [f for f in self._schema().fields if f.name not in (*self.entity, *PARTITIONS, "qualifier", "version")]
        order = F.struct(*[f.name for f in stored if orderable(f.dataType)])
        last = cells.groupBy(*self.entity, "column", "qualifier", "version").agg(
            F.max_by(F.struct(*[f.name for f in stored]), order).alias("_last"))
        return last.select(*self.entity, "column", "qualifier", "version", "_last.*")

    def rebase(self, buckets: int = 64) -> None:
        """Merge all that is written now into a new base, in ``buckets`` files a column and range (K5, A1-A3).

        Reads before, while and after are equal. Writes that go on meanwhile stay deltas of the new base. Choose buckets so that one holds
        some 200 MB; an entity lies in one bucket, so a table with an entity too large for a task is better served by ``compact``.
        Old files stay where they are, for readers that have begun. Two merges at once: the later one fails. Columns without a declared
        type keep their own tables.
        """
        now = self._manifest()
        cells, pending, _ = self._cells()
        base = f"{self.path}/base/{uuid.uuid4().hex}"
        names = [f.name for f in self._schema().fields if f.name not in PARTITIONS]
        rows = self._ranged(self._last_writes(cells)).select(*names, *BASE_PARTITIONS).repartition(buckets, *self.entity)
        rows.write.bucketBy(buckets, *self.entity).sortBy(*self.entity, "qualifier", "version").partitionBy(*BASE_PARTITIONS).option(
            "path", base).saveAsTable(_table_name(base))
        merged = sorted({*now.merged, *pending}) if now else sorted(pending)
        number = now.number + 1 if now else 1
        told = self.spark.createDataFrame([(number, base, buckets, merged)], MANIFEST)
        told.coalesce(1).write.mode("errorifexists").json(f"{self.path}/manifest/{number:012d}")

    def _manifest(self) -> T.Row | None:
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/*").orderBy(F.desc("number")).first()
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            return None  # never rebased

    def _base(self, path: str, buckets: int) -> DataFrame:
        """The base as a table that Spark knows to be bucketed; a session that did not write it is told so."""
        name = _table_name(path)
        if not self.spark.catalog.tableExists(name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema().fields if f.name != "delta")
            keys = ", ".join(f"`{e}`" for e in self.entity)
            self.spark.sql(
                f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({', '.join(f'`{p}`' for p in BASE_PARTITIONS)}) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}, qualifier, version) INTO {buckets} BUCKETS LOCATION '{path}'")
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return self.spark.table(name)

    # --- reading ---

    def _cells(self) -> tuple[DataFrame, set[str], bool]:
        """All rows of declared columns, the deltas that are in no base yet, and whether there is a base."""
        now = self._manifest()
        deltas = self.spark.read.schema(self._schema()).parquet(f"{self.path}/cells")
        # the files are listed already, so this runs no job
        pending = {m[1] for f in deltas.inputFiles() if (m := re.search(r"/delta=(\w+)/", f))}
        if now is None:
            return deltas, pending, False
        pending -= set(now.merged)
        names = [f.name for f in self._schema().fields if f.name != "delta"]
        base = self._base(now.base, now.buckets).select(*names)
        if not pending:
            return base, pending, True
        late = deltas.where(F.col("delta").isin(sorted(pending))).select(*names)
        return base.unionByName(late.repartition(now.buckets, *self.entity)), pending, True

    def table(self) -> CellTable:
        cells, pending, colocated = self._cells()
        keys = [*self.entity, "column", "qualifier", "version"]

        def resolution(slot: str, dtype: T.DataType) -> dict:
            """How the last write of a cell is found. Cells of a base alone are written once; with deltas, rows are resolved before
            anything is renamed, as Spark forgets the partitioning of a union below renamed columns."""
            order = _write_order(slot, dtype)
            if not colocated:
                return {"write_order": order}
            return {"colocated": True, "resolve": (keys, order) if pending else None}

        entity = {e: e for e in self.entity}
        groups: dict[tuple[str, str], list[str]] = {}
        views = []
        for name, layout in self.columns.items():
            family, _, qualifier = name.partition(":")
            if layout.type is None:
                views += self._own_views(name, family, qualifier, entity)
            elif qualifier:
                groups.setdefault((family, self._slot(layout)), []).append(qualifier)
            else:
                mine = cells.where(F.col("column") == name)
                slot = self._slot(layout)
                views.append(LongCells(mine, family, entity, "qualifier", _versions(), slot, **resolution(slot, layout.data_type)))
        for (family, slot), qualifiers in groups.items():
            mine = cells.where(F.col("column").isin([f"{family}:{q}" for q in qualifiers]))
            # Taken from the partition value, so that a filter on it prunes partitions.
            from_partition = F.substring("column", len(family) + 2, 1 << 30)
            views.append(LongCells(
                mine, family, entity, from_partition, _versions(), slot, qualifiers=qualifiers, **resolution(slot, mine.schema[slot].dataType)))
        return CellTable(list(self.entity), views)

    def _own_views(self, name, family, qualifier, entity) -> list[LongCells]:
        try:
            own = self.spark.read.option("mergeSchema", "true").parquet(self._own_path(name))
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            return []  # never written
        qualifiers = [qualifier] if qualifier else None
        order = _write_order("value", own.schema["value"].dataType)
        return [LongCells(own, family, entity, "qualifier", Version.number("version"), "value", order, qualifiers)]

    def scan(self, columns: Mapping[str, str | ColumnRequest] | DataRequest, time_range: TimeRange = ALL_TIME) -> DataFrame:
        return scan(self.table(), columns, time_range)


def _versions() -> Version:
    return Version.number("version", "low", "high")


def _table_name(base: str) -> str:
    return f"cellflow_base_{base.rpartition('/')[2]}"


def _slot_name(type_name: str) -> str:
    return f"value_{type_name}" if type_name.isalnum() else f"value_{zlib.crc32(type_name.encode()):08x}"


def _write_order(value: str, dtype: T.DataType) -> Column:
    return F.struct("batch", "seq", value) if orderable(dtype) else F.struct("batch", "seq")


@dataclass(frozen=True, eq=False)
class CellColumns:
    """Columns of a cell log as a named input or output of a phase."""

    log: CellLog
    columns: Mapping[str, str | ColumnRequest | ColumnOutput]
    time_range: TimeRange = ALL_TIME
    version: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return self.log.scan(self.columns, self.time_range)

    def write(self, rows: DataFrame) -> None:
        self.log.write(rows, self.columns, self.version)


def write_outputs(
    frames: Mapping[str, DataFrame | Callable[[DataFrame], DataFrame]], sinks: Mapping[str, object], parent: DataFrame | None = None
) -> None:
    """Write several named results (K13), each a job of its own.

    With a ``parent``, frames may be functions of it: it is computed once, written to the shared folder, and read by every job.
    """
    unknown = sorted(set(frames) - set(sinks))
    if unknown:
        raise InvalidWrite(f"no output named {', '.join(unknown)}")
    if parent is not None:
        path = f"{shared_folder(parent.sparkSession)}/parent-{uuid.uuid4().hex}"
        parent.write.parquet(path)
        parent = parent.sparkSession.read.schema(parent.schema).parquet(path)
    for name, frame in frames.items():
        sinks[name].write(frame(parent) if callable(frame) else frame)
