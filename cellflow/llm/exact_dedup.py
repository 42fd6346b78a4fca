"""Exact duplicates by a heavy-hitter split.

Texts are equal when they are identical after every run of white space is one blank; equality is decided by the
SHA-256 of that text. Few digests with very many rows are found by Misra-Gries summaries, one per task, which merge
by addition. Their winners (smallest id, exact number of rows) are computed with a map-side combine and broadcast, so
that rows of large groups of copies never meet in one task. All other digests go through one ordinary exchange; a group
there has fewer than ``2 * rows / counters`` rows.

Defined cases: a null text counts as empty, so empty and null texts are one group. Of rows with the same id in a group
exactly one stays. A null id is larger than every other. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflow.llm.common import WHITE, quoted, small_id, stored, text_of

#: Counters of a summary. At most so many digests, and one, are broadcast: about a megabyte.
COUNTERS = 10_000


def digest(text: str) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(text), WHITE, " ").cast("binary"), 256))


def misra_gries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, count) of digests that may be frequent; at most ``counters + 1`` rows.

    A summary's count falls short of the true one by at most its rows / (counters + 1), and so does the sum of all. Every
    digest with ``2 * rows / (counters + 1)`` rows is therefore found.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for pair in pc.value_counts(batch.column(0)).to_pylist():
                counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
            if len(counts) > counters:
                values = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                cut = int(np.partition(values, len(values) - counters - 1)[len(values) - counters - 1])
                counts = {k: v - cut for k, v in counts.items() if v > cut}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "count"])

    rows = digests.count()
    return (
        digests.select("digest").mapInArrow(summary, "digest binary, count bigint")
        .groupBy("digest").agg(F.sum("count").alias("count"))
        .where(F.col("count") >= max(2, rows / (counters + 1)))
    )


def digest_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """Per row: ``id``, ``digest``, ``row``, ``keep`` (the smallest id of the group), ``size``, ``kept``."""
    digests = stored(
        docs.select(F.col(quoted(id_column)).alias("id"), digest(text).alias("digest"),
                    F.monotonically_increasing_id().alias("row")), "digests")
    order = F.struct(small_id(F.col("id")).alias("by"), F.col("row"))
    heavy = F.broadcast(misra_gries(digests, counters).select("digest"))
    winners = stored(
        digests.join(heavy, "digest").groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("size")),
        "winners")
    large = digests.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = (
        digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .select("*", F.min(order).over(group).alias("first"), F.count("*").over(group).alias("size"))
    )
    return large.unionByName(rest).select(
        "id", "digest", "row", F.col("first.by.value").alias("keep"), "size", (F.col("row") == F.col("first.row")).alias("kept"))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document, dropped ones too: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    return digest_groups(docs, id_column, text, counters).select(
        F.col("id").alias(id_column), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one_copy(docs: DataFrame, id_column: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.

    Dropped rows are taken away by id and digest. Rows that share both with the row that stays are told apart by nothing but
    their other columns; of those one is taken, with a map-side combine.
    """
    groups = stored(digest_groups(docs, id_column, text, counters), "groups")
    same = F.col("id").eqNullSafe(F.col("keep"))
    dropped = groups.where(~same).select(F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    twins = groups.where(same & ~F.col("kept")).select(F.col("id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(quoted(c)) for c in names]).alias("_doc"), F.col(quoted(id_column)).alias("_own"),
                        digest(text).alias("_text"))
    meets = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_digest"))
    once = whole.join(dropped, meets, "left_anti").join(twins, meets, "left_anti").select("_doc")
    if not twins.isEmpty():
        again = whole.join(twins, meets, "left_semi").groupBy("_own", "_text").agg(F.first("_doc").alias("_doc")).select("_doc")
        once = once.unionByName(again)
    return once.select(*[F.col("_doc").getField(c).alias(c) for c in names])
