"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflow.functions import as_column
from cellflow.session import shared_folder

#: Bytes of a batch of whole texts that is exchanged with Python. A task holds a batch several times over: in the vectors that Spark fills, in what
#: it reads back, and in the worker.
BATCH_BYTES = 1 << 22

#: White space as the contracts name it: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage: what follows survives the loss of any executor and does not compute the frame again.
    """
    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_id(column: Column) -> Column:
    """An order of ids in which null comes last: minimum of this struct is the smallest id."""
    return F.struct(column.isNull().alias("missing"), as_column(column).alias("value"))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside exchange batches of so many rows with Python, for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def arrow_bytes(spark: SparkSession, size: int | None = None) -> Iterator[None]:
    """Jobs that run inside exchange batches of about so many bytes with Python, BATCH_BYTES if none is given; a longer row is a batch alone."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size or BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def held(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    The optimizer would copy an expression into every lambda that names it, where it is computed again for every element. A
    one-row generator keeps it apart.
    """
    return frame.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
