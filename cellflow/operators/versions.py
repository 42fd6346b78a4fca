"""Resolving cells: latest write per version and latest N versions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark cuts every group to N rows in each task before the exchange. That is enough for a hot group
# while N is small; it is not done beyond this setting, and for a large N the rows left of a hot group
# add up over many tasks.
GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"
SMALL_LIMIT = 100
SPREAD = 1024
# Rows that a task gathers before it cuts them to its newest versions.
STATE_ROWS = 200_000
# For types that the state of a task cannot hold: parts of a key whose newest versions are cut separately, so that the rewrites of one cell
# are not one task's.
PARTS = 4


def newest(value: str | Column, version: str | Column = "version") -> Column:
    """Aggregate: the value of the highest version."""
    return F.max_by(value, version)


def oldest(value: str | Column, version: str | Column = "version") -> Column:
    """Aggregate: the value of the lowest version."""
    return F.min_by(value, version)


def resolve_writes(rows: DataFrame, keys: Sequence[str], order: str = "_order") -> DataFrame:
    """Keep the last write of every cell (K5).

    Grouped on the full cell address with a partial aggregate, so neither a hot entity nor a cell
    rewritten very often ends up as raw rows in one task.
    """
    return rows.groupBy(*keys, "version").agg(F.max_by("value", order).alias("value"))


def latest_versions(
    rows: DataFrame, keys: Sequence[str], max_versions: int | None, order: str | None = None,
    by: Sequence[str] | None = None, colocated: bool = False,
) -> DataFrame:
    """The newest ``max_versions`` cells per ``keys``; None keeps all.

    ``rows`` has the key columns, ``version``, ``value`` and, if cells may be written more than
    once, ``order``. The result has the keys, ``version`` and ``value``. ``by`` names some of the keys if what follows groups on
    them alone, so that the rows are exchanged once for both. ``colocated``: the rows of a key are together already.
    """
    keys = list(keys)
    if max_versions == 1:
        rank = F.col("version") if order is None else F.struct("version", order)
        return rows.groupBy(*keys).agg(
            F.max("version").alias("version"), F.max_by("value", rank).alias("value")
        )
    if max_versions is None:
        return (rows if order is None else resolve_writes(rows, keys, order)).select(*keys, "version", "value")
    limited = max_versions <= min(SMALL_LIMIT, int(rows.sparkSession.conf.get(GROUP_LIMIT_SETTING)))
    if order is not None and limited and not colocated:
        return _newest_written(rows, keys, max_versions, order, by or keys)
    cells = rows if order is None else resolve_writes(rows, keys, order)
    cells = cells.select(*keys, "version", "value")
    if not limited and not colocated:
        # Cut hot groups in parts first.
        spread = F.pmod(F.xxhash64("version"), F.lit(SPREAD))
        cells = _limit(cells.withColumn("_spread", spread), [*keys, "_spread"], max_versions).drop("_spread")
    return _limit(cells, keys, max_versions)


def _newest_written(rows: DataFrame, keys: Sequence[str], n: int, order: str, by: Sequence[str]) -> DataFrame:
    """Latest versions of cells that may be written again, without moving the history: one exchange.

    Every task first keeps, per key, its N newest versions with the last write of each; that state merges like a sum, so what
    is exchanged is at most N rows a task and key, however often a cell was written. The states then meet by key.
    """
    schema = rows.select(*keys, "version", "value", order).schema
    names = [f.name for f in schema.fields]
    if all(_ranked(schema[k].dataType) for k in [*keys, "version", order]) and _carried(schema["value"].dataType):
        kept = rows.select(*names).mapInArrow(_newest_of_task(list(keys), order, n), schema)
        written = kept.repartition(*by).groupBy(*keys, "version").agg(F.max_by("value", order).alias("value"))
        return _limit(written, keys, n)
    part = F.pmod(F.xxhash64("version", order), F.lit(PARTS))
    newest_first = Window.partitionBy(*keys, "_part").orderBy(F.col("version").desc())
    cut = rows.withColumn("_part", part).withColumn("_rank", F.dense_rank().over(newest_first)).where(F.col("_rank") <= n)
    written = cut.groupBy(*keys, "_part", "version").agg(F.max_by("value", order).alias("value"), F.max(order).alias("_last"))
    written = written.repartition(*by).groupBy(*keys, "version").agg(F.max_by("value", "_last").alias("value"))
    return _limit(written, keys, n)


def _ranked(t: T.DataType) -> bool:
    """Types whose order ``_leaves`` reproduces."""
    if isinstance(t, T.StructType):
        return all(_ranked(f.dataType) for f in t.fields)
    return type(t) in (
        T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.BinaryType,
        T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _carried(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_carried(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _carried(t.elementType)
    return _carried(t.keyType) and _carried(t.valueType) if isinstance(t, T.MapType) else _ranked(t)


def _leaves(array: pa.Array) -> list[np.ndarray]:
    """Whole numbers that order rows as Spark orders their values: NULL first, NaN last, records field by field."""
    valid = array.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
    if pa.types.is_struct(array.type):
        return [valid, *[leaf for i in range(array.type.num_fields) for leaf in _leaves(pc.struct_field(array, i))]]
    if pa.types.is_floating(array.type):
        numbers = array.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
        bits = np.where(np.isnan(numbers), np.nan, numbers + 0.0).view(np.int64)  # one zero, one NaN
        return [valid, np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)]
    if pa.types.is_boolean(array.type) or pa.types.is_integer(array.type):
        return [valid, array.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)]
    if pa.types.is_date(array.type):
        return [valid, array.cast(pa.int32()).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)]
    if pa.types.is_timestamp(array.type):
        return [valid, array.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)]
    return [pc.rank(array, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)]


def newest_rows(table: pa.Table, keys: Sequence[str], order: str, n: int) -> pa.Table:
    """The last write of each of the N newest versions of every key."""
    of = lambda name: _leaves(table.column(name).combine_chunks())
    key, version, last = [leaf for k in keys for leaf in of(k)], of("version"), of(order)
    at = np.lexsort([*[~x for x in reversed([*version, *last])], *reversed(key)])

    def changes(columns: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(at), dtype=bool)
        out[:1] = True
        for c in columns:
            out[1:] |= c[at][1:] != c[at][:-1]
        return out

    new_key = changes(key)
    new_cell = new_key | changes(version)
    cells = np.cumsum(new_cell)
    nth = cells - cells[np.flatnonzero(new_key)][np.cumsum(new_key) - 1]
    return table.take(pa.array(at[new_cell & (nth < n)]))


def _newest_of_task(keys: list[str], order: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= STATE_ROWS:
                state = newest_rows(pa.concat_tables(held), keys, order, n)
                if state.num_rows > STATE_ROWS // 2:  # too many keys to hold: the exchange merges them
                    yield from state.to_batches()
                    state = state.slice(0, 0)
                held, size = [state], state.num_rows
        if size:
            yield from newest_rows(pa.concat_tables(held), keys, order, n).to_batches()

    return run


def _limit(cells: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    newest_first = Window.partitionBy(*keys).orderBy(F.col("version").desc())
    return cells.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= n).drop("_rank")
