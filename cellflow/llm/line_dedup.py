"""Lines that repeat across documents, found in content-defined chunks of lines, with SQL functions only.

Every line gets a 32-bit hash (the first digits of its MD5). A rolling polynomial over the hashes of three consecutive lines
marks lines; a chunk ends after a marked line whose predecessor is not marked. A boundary thus depends on four lines only, an
insertion shifts no later boundary, and only the last chunk of a document can have one line. Chunks of at
least ``min_lines`` lines whose hash occurs more than once anywhere are compared byte by byte; the first occurrence (smallest id,
then position) stays and all others are removed.

Only repeated chunks carry their text through an exchange. Counting and the choice of the first occurrence combine before they
shuffle, and the joins are plain equi-joins that adaptive execution splits, so a passage in a third of all documents is no hot task.

Defined cases: a null text is empty and has one empty line. Rows that repeat both id and text are one document and get the same
result. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.llm.common import held, quoted, small_id, stored, text_of

#: Lines with rolling hash 0 modulo this are marked.
DIVISOR = 3
MIN_LINES = 2
#: The rolling polynomial: weights of a line and the two before it, and the modulus.
WEIGHTS = (1, 31, 961)
MODULUS = 1_000_003


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def chunked(docs: DataFrame, id_column: str, text: str, divisor: int) -> DataFrame:
    """(id, key, line, number, chunk) per document: its lines and its chunks as (number, first line from 0, lines)."""
    rows = docs.select(F.col(quoted(id_column)).alias("id"), text_of(text).alias("text"))
    rows = held(rows, key=F.unhex(F.md5("text")), lines=F.split("text", "\n", -1)).drop("text")
    rows = held(rows, hashes=F.transform("lines", line_hash))

    def marked(h: Column, i: Column) -> Column:
        rolled = WEIGHTS[0] * h
        for back, weight in enumerate(WEIGHTS[1:], 1):
            rolled = rolled + F.when(i >= back, weight * F.get("hashes", i - back)).otherwise(0)
        return (rolled % MODULUS) % divisor == 0

    def ends(mark: Column, i: Column) -> Column:
        first = mark & ((i == 0) | ~F.get("marks", i - 1))
        return F.when(first | (i == F.size("marks") - 1), i + 1)

    rows = held(rows, marks=F.transform("hashes", marked)).drop("hashes")
    rows = held(rows, ends=F.filter(F.transform("marks", ends), lambda e: e.isNotNull()))
    return rows.select("id", "key", "lines", F.transform("ends", lambda e, j: F.struct(
        j.alias("number"), F.when(j == 0, 0).otherwise(F.get("ends", j - 1)).alias("start"),
        (e - F.when(j == 0, 0).otherwise(F.get("ends", j - 1))).alias("n_lines"))).alias("chunks"))


def repeated_chunks(docs: DataFrame, id_column: str, text: str, min_lines: int, divisor: int) -> DataFrame:
    """(id, key, number) of the chunk occurrences to remove."""
    cut = chunked(docs, id_column, text, divisor)
    chunks = cut.select("id", "key", "lines", F.explode("chunks").alias("chunk")).where(F.col("chunk.n_lines") >= min_lines)
    chunks = chunks.select("id", "key", F.col("chunk.number").alias("number"), F.array_join(
        F.slice("lines", F.col("chunk.start") + 1, F.col("chunk.n_lines")), "\n").alias("chunk"))
    chunks = chunks.withColumn("hash", F.unhex(F.md5("chunk")))
    counted = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    met = stored(chunks.join(counted, "hash", "left_semi"), "chunks")
    place = F.struct(small_id(F.col("id")).alias("by"), F.col("key"), F.col("number"))
    first = met.groupBy("hash", "chunk").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    return (
        met.join(first, ["hash", "chunk"]).where(place != F.col("first"))
        .select("id", "key", "number").distinct()
    )


def line_dedup(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, divisor: int = DIVISOR,
) -> DataFrame:
    """Per document: id, ``n_lines``, ``n_removed`` lines, ``text`` without the removed lines."""
    removed = repeated_chunks(docs, id_column, text, min_lines, divisor)
    lists = removed.groupBy("id", "key").agg(F.array_sort(F.collect_set("number")).alias("numbers"))
    cut = chunked(docs, id_column, text, divisor).alias("d")
    lists = lists.alias("r")
    joined = cut.join(lists, F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.key") == F.col("r.key")), "left").select(
        "d.*", F.coalesce(F.col("numbers"), F.array().cast("array<int>")).alias("numbers"))
    kept = F.filter("chunks", lambda c: ~F.array_contains("numbers", c["number"]))
    left = F.flatten(F.transform("kept", lambda c: F.slice("lines", c["start"] + 1, c["n_lines"])))
    rows = held(held(joined, kept=kept), left=left)
    return rows.select(
        F.col("id").alias(id_column), F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("bigint").alias("n_removed"), F.array_join("left", "\n").alias("text"))
