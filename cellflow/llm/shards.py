"""Training-order materialisation: token sequences in a keyed pseudo-random order, in shards of fixed stride.

Tasks encode their documents, each closed by an end id, into one stream and cut it into sequences of ``length`` ids. A sequence has a number:
the offset of its task, known beforehand from the sizes of the texts in bytes (no text has more ids than bytes), plus its place in
the task. A keyed Feistel network with cycle-walking permutes the range of these numbers; the images are dealt in ranges to shards, are sorted in each, and
the sequences are written one behind the other, ``2 * length`` bytes each (little-endian 16-bit ids). As the range is an upper bound, some numbers are
unused; the global slot of a sequence is its rank among the used images: the sequences of earlier shards plus its place in
its own. Reading in training order is thus sequential, and can resume at any slot by arithmetic and one seek.

A shard is written under a name of the attempt and then renamed, so a repeated task leaves the same file. The order depends on the key and
on how the input is split into tasks; numbers beyond the bound of a task raise an error.

Defined cases: a null or empty text is the end id alone. Repeated rows and ids, and null ids, are kept like any other. An empty table
gives no shard. The last sequence of a task is padded with end ids; ``n_tokens`` tells its real length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellflow.llm.common import arrow_rows, quoted, scratch, stored, text_of
from cellflow.llm.packing import encoder

LENGTH = 1024
END = 50256
#: Numbers that a shard covers; well under half of them are used, of 2 KB each.
NUMBERS = 16_384
ROUNDS = 6
PIECE = 128
#: Rows of an Arrow batch, of a document or a sequence each.
ROWS = 512


def _round(half: np.ndarray, key: int, r: int) -> np.ndarray:
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed bijection of 0 .. size - 1."""
    half = np.uint64(max(1, -(-max(1, (size - 1).bit_length()) // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # cycle-walking: the network permutes less than four times the range
        left, right = out[todo] >> half, out[todo] & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, r) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


SEQUENCE = "shard int, image bigint, number bigint, n_tokens int, doc_ids array<bigint>, ids binary"


def sequences(docs: DataFrame, offsets: dict[int, tuple[int, int]], size: int, key: int, ranks_path: str, pattern: str, length: int) -> DataFrame:
    """All sequences with their image. offsets: per task its first number and how many it may use."""
    sent = docs.sparkSession.sparkContext.broadcast(offsets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks_path, pattern)
        first, most = sent.value.get(TaskContext.get().partitionId(), (0, 0))
        used, held, owners = 0, np.zeros(0, np.uint16), []  # owners: (first position in held, id)

        def cut(n: int, pad: bool) -> pa.RecordBatch:
            nonlocal used, held, owners
            if used + n > most:
                raise RuntimeError("the input of this task is not the one that was measured")
            image = permuted(first + used + np.arange(n), size, key)
            ids, tokens, names = [], [], []
            begins = np.array([b for b, _ in owners], dtype=np.int64)
            for k in range(n):
                own = held[k * length:(k + 1) * length]
                tokens.append(len(own))
                lo = int(np.searchsorted(begins, k * length, side="right")) - 1
                hi = int(np.searchsorted(begins, k * length + len(own), side="left"))
                names.append([i for _, i in owners[lo:hi]])
                ids.append(np.pad(own, (0, length - len(own)), constant_values=END).astype("<u2").tobytes())
            number = first + used + np.arange(n)
            used += n
            if not pad:
                held = held[n * length:]
                lo = int(np.searchsorted(begins, n * length, side="right")) - 1
                owners = [(b - n * length, i) for b, i in owners[lo:]] if len(held) else []
            return pa.RecordBatch.from_arrays(
                [pa.array((image // NUMBERS).astype(np.int32)), pa.array(image), pa.array(number), pa.array(tokens, pa.int32()),
                 pa.array(names, pa.list_(pa.int64())), pa.array(ids, pa.binary())],
                ["shard", "image", "number", "n_tokens", "doc_ids", "ids"])

        for batch in batches:
            for lo in range(0, batch.num_rows, PIECE):
                part = batch.slice(lo, PIECE)
                at, parts = len(held), [held]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own = np.array(encoding.encode_ordinary(text) + [END], dtype=np.uint16)
                    owners.append((at, doc))
                    at += len(own)
                    parts.append(own)
                held = np.concatenate(parts)
                if len(held) >= length:
                    yield cut(len(held) // length, False)
        if len(held):
            yield cut(1, True)

    return docs.mapInArrow(run, SEQUENCE)


def _written(folder: str):
    """Write the sequences of sorted shards; gives their rows without the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        attempt = TaskContext.get().taskAttemptId()
        shard, out, place = None, None, 0

        def close() -> None:
            if out is not None:
                out.close()
                final = f"{path}/shard-{shard:08d}.bin"
                if system.get_file_info(final).type != fs.FileType.NotFound:
                    system.delete_file(final)
                system.move(f"{final}.{attempt}", final)

        system.create_dir(path, recursive=True)
        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            places, ids = [], batch.column(5).to_pylist()
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if shards[lo] != shard:
                    close()
                    shard, place = int(shards[lo]), 0
                    out = system.open_output_stream(f"{path}/shard-{shard:08d}.bin.{attempt}")
                out.write(b"".join(ids[lo:hi]))
                places.append(np.arange(place, place + hi - lo))
                place += hi - lo
            codes = pa.array([zlib.crc32(b) for b in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(places) if places else np.zeros(0, np.int64)), *(batch.column(c) for c in (2, 3, 4)), codes],
                ["shard", "place", "number", "n_tokens", "doc_ids", "ids_crc32"])
        close()

    return run


def materialise(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, key: int = 20240,
    folder: str | None = None,
) -> DataFrame:
    """Write the shards and give the manifest: ``slot``, ``shard``, ``place``, ``number``, ``n_tokens``, ``doc_ids``, ``ids_crc32``.

    docs must be a table that is split in the same way whenever it is read, as Parquet files are.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "shards")
    own = docs.select(F.col(quoted(id_column)).cast("bigint").alias("id"), text_of(text).alias("text"))
    bytes_of = own.select(F.spark_partition_id().alias("task"), (F.octet_length("text") + 1).alias("n")).groupBy("task").agg(F.sum("n").alias("n"))
    offsets, size = {}, 0
    for r in bytes_of.orderBy("task").collect():  # a row for each task
        most = -(-r["n"] // length)
        offsets[r["task"]] = (size, most)
        size += most
    made = sequences(own, offsets, size, key, ranks_path, pattern, length)
    shards = max(1, -(-size // NUMBERS))
    with arrow_rows(spark, ROWS):
        manifest = stored(
            made.repartition(shards, "shard").sortWithinPartitions("shard", "image").mapInArrow(
                _written(folder), "shard int, place bigint, number bigint, n_tokens int, doc_ids array<bigint>, ids_crc32 bigint"), "manifest")
    # one row a shard
    starts = manifest.groupBy("shard").agg(F.count("*").alias("n")).withColumn(
        "start", F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    rows = manifest.join(starts.select("shard", "start"), "shard")
    return rows.select((F.col("start") + F.col("place")).alias("slot"), "shard", "place", "number", "n_tokens", "doc_ids", "ids_crc32")


def read_from(spark: SparkSession, folder: str, manifest: DataFrame, slot: int = 0, length: int = LENGTH) -> DataFrame:
    """(slot, ids) from a slot on: one task a shard, each a sequential read from one seek."""
    left = manifest.where(F.col("slot") >= slot).groupBy("shard").agg(
        F.min("place").alias("place"), F.min("slot").alias("slot"), F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{path}/shard-{row['shard']:08d}.bin") as file:
                    file.seek(row["place"] * 2 * length)
                    for k in range(0, row["n"], 256):
                        n = min(256, row["n"] - k)
                        data = np.frombuffer(file.read(n * 2 * length), dtype="<u2").astype(np.int32)
                        lists = pa.FixedSizeListArray.from_arrays(pa.array(data), length).cast(pa.list_(pa.int32()))
                        yield pa.RecordBatch.from_arrays([pa.array(row["slot"] + k + np.arange(n)), lists], ["slot", "ids"])

    return left.repartition("shard").mapInArrow(run, "slot bigint, ids array<int>")
