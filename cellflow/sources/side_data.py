"""Side data: key/value frames looked up by rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflow.functions import as_column
from cellflow.operators.joins import broadcasts, is_small, skewed_join
from cellflow.sources.cells import CellTable
from cellflow.sources.requests import ColumnRequest, as_request
from cellflow.sources.scan import scan_cells


def key_values(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A file with fields ``key`` and ``value``; other fields are ignored."""
    return spark.read.format(format).load(path).select("key", "value")


def records(spark: SparkSession, path: str, key_field: str, format: str = "parquet") -> DataFrame:
    """Whole records under one of their fields, which may itself be a record."""
    rows = spark.read.format(format).load(path)
    return rows.select(F.col(key_field).alias("key"), F.struct("*").alias("value"))


def table_column(table: CellTable, column: str | ColumnRequest) -> DataFrame:
    """Newest value of one column by entity (A20). A composite entity becomes a struct key."""
    request = as_request(column)
    if request.qualifier is None:
        raise ValueError(f"{request.name}: side data needs a single column")
    key = F.col(table.entity[0]) if len(table.entity) == 1 else F.struct(*table.entity)
    return scan_cells(table, request).select(key.alias("key"), "value")


def delimited_text(spark: SparkSession, path: str, delimiter: str = "\t") -> DataFrame:
    """Lines of key, delimiter, value."""
    at = F.locate(delimiter, F.col("value"))
    return spark.read.text(path).select(
        F.when(at > 0, F.substring("value", F.lit(1), at - 1)).otherwise(F.col("value")).alias("key"),
        F.when(at > 0, F.substring("value", at + len(delimiter), F.length("value"))).alias("value"),
    )


def unique_keys(side: DataFrame, keep_first_by: str | Column | None = None) -> DataFrame:
    """One row per key. Repeated keys fail, unless an order says which row comes first."""
    if keep_first_by is not None:
        return side.groupBy("key").agg(F.min_by("value", as_column(keep_first_by)).alias("value"))
    message = F.concat(F.lit("side data repeats the key "), F.to_json(F.struct("key")))
    grouped = side.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.any_value("value").alias("value"))
    return grouped.select("key", F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("value")).alias("value"))


def lookup(
    rows: DataFrame,
    side: DataFrame,
    key: str | Column,
    out: str,
    on_missing: str = "error",
    keep_first_by: str | Column | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Add the side value of ``key`` (D6). A NULL key fails; so does an absent one, unless
    ``on_missing`` is "null".

    How is chosen before a job, by the size that the plan and the files of the side data tell: a side below Spark's broadcast
    threshold is joined plainly, and Spark broadcasts it, so the rows are read once and not exchanged. Any other is joined by key, with the
    heavy keys of the rows spread. ``small=False`` asks for that at once; ``small=True`` for a broadcast beyond the threshold, which is
    done only if rows and bytes, measured then, allow it.
    """
    if on_missing not in ("error", "null"):
        raise ValueError('on_missing is "error" or "null"')
    joined = _attach(rows, side, key, keep_first_by, small)
    value = F.col("_side.value")
    if on_missing == "error":
        message = F.concat(F.lit("side data has no key "), F.to_json(F.struct(F.col("_key").alias("key"))))
        value = F.when(F.col("_side").isNull(), F.raise_error(message)).otherwise(value)
    return joined.select(*rows.columns, value.alias(out))


def contains_key(
    rows: DataFrame, side: DataFrame, key: str | Column, out: str, small: bool | None = None
) -> DataFrame:
    """Add whether the side data holds ``key``; values may repeat here."""
    keys = side.select("key").distinct().withColumn("value", F.lit(True))
    joined = _attach(rows, keys, key, None, small, unique=True)
    return joined.select(*rows.columns, F.col("_side").isNotNull().alias(out))


def _attach(
    rows: DataFrame,
    side: DataFrame,
    key: str | Column,
    keep_first_by: str | Column | None,
    small: bool | None,
    unique: bool = False,
) -> DataFrame:
    hinted = bool(small) and is_small(side)  # a hint is measured before it is believed
    side = side if unique else unique_keys(side, keep_first_by)
    side = side.select(F.col("key").alias("_key"), F.struct("value").alias("_side"))
    key = as_column(key)
    checked = F.when(key.isNull(), F.raise_error(F.lit("the side data key is null"))).otherwise(key)
    keyed = rows.withColumn("_key", checked)
    if hinted:
        return keyed.join(F.broadcast(side), "_key", "left")
    if small is None and broadcasts(side):
        return keyed.join(side, "_key", "left")
    return skewed_join(keyed, side, ["_key"], "left")
