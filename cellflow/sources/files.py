"""Text, TSV and sequence files as sources and sinks."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellflow.operators.joins import is_small
from cellflow.session import written


def text_lines(spark: SparkSession, path: str, offsets: bool = False) -> DataFrame:
    """Lines as ``line``, with the byte ``offset`` of each in its file if asked for."""
    if not offsets:
        return spark.read.text(path).withColumnRenamed("value", "line")
    return placed_lines(spark, path).select("offset", "line")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as ``line``, with the ``file`` of each and its byte ``offset`` there.

    Offsets come from two passes over the blocks that files are split into: the bytes of each block, then the places of lines in it.
    A line ends with a line feed, a carriage return or both. A byte order mark counts as no bytes.
    """
    blocks = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    # The lines of a block begin where those of the blocks before it in the file end. A file has one row a block here.
    sizes = blocks.groupBy("_file", "_block").agg(F.sum(F.octet_length("value").cast("bigint") + 1).alias("_bytes"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begins = written(sizes.select("_file", "_block", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_begin")), "blocks")
    if is_small(begins):  # a row for each block; with very many of them lines are exchanged by block instead
        begins = F.broadcast(begins)
    placed = blocks.mapInArrow(_places_in_block, "_file string, _block bigint, _at bigint, line string")
    return placed.join(begins, ["_file", "_block"]).select(
        F.col("_file").alias("file"), (F.col("_begin") + F.col("_at")).alias("offset"), "line")


def _places_in_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, file, block), in the order of the file, to (file, block, offset in the block, line). A carriage return ends a line, too."""
    block, reached = None, 0
    for batch in batches:
        value = batch.column(0).cast(pa.large_string())
        size = pc.binary_length(value).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        files, starts = batch.column(1), batch.column(2).to_numpy()
        change = np.ones(batch.num_rows, dtype=bool)
        change[1:] = (starts[1:] != starts[:-1]) | pc.not_equal(files.slice(1), files.slice(0, max(0, batch.num_rows - 1))).to_numpy(zero_copy_only=False)
        begin = np.cumsum(size) - size
        for lo, hi in itertools.pairwise([*np.flatnonzero(change).tolist(), batch.num_rows]):
            own = (files[lo].as_py(), int(starts[lo]))
            carried = reached if own == block else 0
            at = begin[lo:hi] - begin[lo] + carried
            block, reached = own, int(carried + size[lo:hi].sum())
            part = value.slice(lo, hi - lo)
            if pc.any(pc.match_substring(part, "\r")).as_py():
                lines, inside = [], []
                for start, text in zip(at.tolist(), part.to_pylist(), strict=True):
                    for line in text.removesuffix("\r").split("\r"):
                        lines.append(line)
                        inside.append(start)
                        start += len(line.encode()) + 1
                at, part = np.array(inside, dtype=np.int64), pa.array(lines, pa.large_string())
            rows = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(own[0]), rows), pa.repeat(pa.scalar(own[1], pa.int64()), rows), pa.array(at), part.cast(pa.string())],
                ["_file", "_block", "_at", "line"])


def sequence_file(spark: SparkSession, path: str, schema: str = "key string, value string") -> DataFrame:
    """Key and value of a sequence file under the names and types of ``schema``."""
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), schema)


def write_text(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All columns of a row as one line, tab between them."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in rows.columns])
    rows.select(line.alias("value")).write.mode(mode).text(path)


def write_tsv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("sep", "\t").csv(path)


def write_sequence_file(rows: DataFrame, path: str, fields: Sequence[str] | None = None) -> None:
    """Two columns as key and value (K12); PySpark has this format for RDDs only."""
    pair = list(fields or rows.columns)
    if len(pair) != 2:
        raise ValueError(f"a sequence file has a key and a value, not {pair}")
    rows.select(*pair).rdd.map(tuple).saveAsSequenceFile(path)


@dataclass(frozen=True)
class TextFile:
    """Named input or output of a phase."""

    path: str
    offsets: bool = False
    mode: str = "overwrite"

    def read(self, spark: SparkSession) -> DataFrame:
        return text_lines(spark, self.path, self.offsets)

    def write(self, rows: DataFrame) -> None:
        write_text(rows, self.path, self.mode)


@dataclass(frozen=True)
class TsvFile:
    path: str
    schema: str
    mode: str = "overwrite"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).option("sep", "\t").csv(self.path)

    def write(self, rows: DataFrame) -> None:
        write_tsv(rows, self.path, self.mode)


@dataclass(frozen=True)
class SequencePairs:
    path: str
    schema: str = "key string, value string"
    fields: tuple[str, str] | None = None

    def __post_init__(self):
        if self.fields is not None and len(self.fields) != 2:
            raise ValueError("name both the key and the value field, or neither")

    def read(self, spark: SparkSession) -> DataFrame:
        rows = sequence_file(spark, self.path, self.schema)
        return rows.toDF(*self.fields) if self.fields else rows

    def write(self, rows: DataFrame) -> None:
        write_sequence_file(rows, self.path, self.fields)


@dataclass(frozen=True)
class ParquetFile:
    path: str
    mode: str = "overwrite"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def write(self, rows: DataFrame) -> None:
        rows.write.mode(self.mode).parquet(self.path)
