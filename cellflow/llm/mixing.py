"""Mixing sources to target weights with hash-threshold histograms.

Every document has a size in words and a hash of its id and text. A source is given a target number of words; it is taken whole as often as
that fits, and of what then remains the documents below a threshold of the hash are taken once more. The threshold comes from
histograms, without a sort: words are summed by source and leading digit of the hash, the bucket in which the remaining budget ends is the
boundary, and only its documents are summed again by their next digit, until one hash is left. Sums combine in every task before they are
shuffled, and a source has at most 2^10 and then 2^17 buckets, so a source with a third of all rows is no large group.

The thresholds of a source are nested: what a smaller target takes is part of what a larger one takes. The document at the threshold is
taken up to the words that are missing, so a source comes within a word of its target. Rows that are equal in id and text have the same
hash; if they lie at the threshold each gives its share, rounded down.

Targets: sources in the order of their code points, the missing one last, have the weights in turn and share a multiple of all words. A
target ends at a multiple of its source's words, and what is above is shared again by weight until none is above. That is solved with
running sums over the sources, one row each; a source is something that is named and weighted, so one task may hold them all.

Defined cases: a null text has no words, and a document without words gives none. Null, empty and repeated ids are rows like any
other. Null sources are one source. A source without words has the target 0. An empty table gives no rows. Other columns are not
looked at. Reruns give the same rows, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflow.llm.common import held, quoted, stored, text_of
from cellflow.operators.joins import skewed_join

#: Bits of the digits of a hash, the leading ones first.
DIGITS = (10, 16, 17, 17)
#: Weights in turn, the part of all words that is shared, and how often a document is taken at most.
WEIGHTS, SHARE, MOST = (1, 2, 3), 1, 3
#: Sources up to which their table, one row each, is broadcast; beyond that it is joined with hot sources spread.
SOURCES = 100_000

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def place(identity: Column, text: Column) -> Column:
    """60 bits of a hash of a document."""
    name = F.concat(F.coalesce(identity.cast("string"), F.lit("")), F.lit("\n"), text)
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, sum(DIGITS) // 4), 16, 10).cast("bigint")


def measured(docs: DataFrame, id_column: str, text: str, source: str) -> DataFrame:
    """id, source, size and hash of every document."""
    identity = F.col(quoted(id_column))
    return docs.select(
        identity.alias("id"), F.col(quoted(source)).cast("string").alias("source"), n_words(text_of(text)).alias("size"),
        place(identity, text_of(text)).alias("hash"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` to (source, source_size)."""
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("bigint"))
    ranked = ranked.withColumn("words", share * F.sum("source_size").over(every)).withColumn("cap", most * F.col("source_size"))
    # the source that would end first when all targets grow together stands first: those at their end are the first so many
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    full = ranked.withColumn("full", (F.col("words") - before) * F.col("weight") > F.col("cap") * after)
    rest = full.withColumn("left", F.col("words") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(every)).withColumn(
        "among", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(every))
    own = (F.col("left") * F.col("weight")).cast("double") / F.col("among")
    return rest.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(own).alias("target"))


def by_source(rows: DataFrame, table: DataFrame, sources: int) -> DataFrame:
    """Rows with the columns of a stored table that has one row for each source."""
    if sources > SOURCES:
        return skewed_join(rows, table, ["source"])
    of = table.withColumnRenamed("source", "_source")
    return rows.join(F.broadcast(of), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def thresholds(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST) -> DataFrame:
    """Per source of measured rows, a stored table: source_size, target, ``passes`` of the whole source, and then the hash ``cut`` below which
    documents are taken once more; those at it give ``part`` of their ``tied`` words."""
    width = sum(DIGITS)
    buckets = stored(
        rows.groupBy("source", F.shiftright("hash", width - DIGITS[0]).alias("digit")).agg(F.sum("size").alias("words")), "buckets")
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    whole = F.least(F.floor(F.col("target") + 0.5).cast("bigint"), most * F.col("source_size"))
    plan = targets(sizes, weights, share, most).withColumn("whole", whole).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.expr("whole div source_size")).otherwise(0).alias("passes"),
        F.when(F.col("source_size") > 0, F.expr("whole % source_size")).otherwise(0).alias("budget"))
    plan = stored(plan, "targets")
    sources = plan.count()
    below = Window.partitionBy("source").orderBy("digit")
    reached = F.coalesce(F.sum("words").over(below.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    goal = plan.select("source", F.lit(0).cast("bigint").alias("prefix"), "budget")
    used = 0
    for level, digit in enumerate(DIGITS):
        used += digit
        if level:
            # of the boundary bucket alone
            rows = by_source(rows.select("source", "size", "hash"), goal.select("source", "prefix"), sources)
            rows = stored(rows.where(F.shiftright("hash", width - used + digit) == F.col("prefix")).drop("prefix"), "boundary")
            buckets = rows.groupBy("source", F.shiftright("hash", width - used).bitwiseAND((1 << digit) - 1).alias("digit")).agg(
                F.sum("size").alias("words"))
        ended = by_source(buckets.withColumn("before", reached), goal.select("source", "prefix", "budget"), sources).where("before <= budget AND budget < before + words")
        goal = stored(ended.select(
            "source", (F.shiftleft("prefix", digit) + F.col("digit")).alias("prefix"), (F.col("budget") - F.col("before")).alias("budget"), "words"),
            "thresholds")
    cut = goal.select(F.col("source").alias("_source"), F.col("prefix").alias("cut"), F.col("budget").alias("part"), F.col("words").alias("tied"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    return stored(plan.join(cut, same, "left").drop("_source", "budget"), "mix")


def taken() -> Column:
    """Words taken of a document, repeats counted, from its size and hash and the columns of ``thresholds``."""
    # part < tied, so the share is less than the size; the product may leave the range of bigints
    share = F.expr("(cast(part AS decimal(19, 0)) * cast(size AS decimal(18, 0))) div cast(tied AS decimal(19, 0))")
    last = F.when(F.col("hash") < F.col("cut"), F.col("size")).when(F.col("hash") == F.col("cut"), share).otherwise(F.lit(0))
    return (F.col("passes") * F.col("size") + last).cast("bigint")


def mix(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST,
) -> DataFrame:
    """Per document: its id and source, ``size``, ``source_size``, ``target`` and ``taken``."""
    rows = stored(measured(docs, id_column, text, source), "sizes")
    table = thresholds(rows, weights, share, most)
    return by_source(rows, table, table.count()).select(
        F.col("id").alias(id_column), "source", "size", "source_size", "target", taken().alias("taken"))


def mixed_texts(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST,
) -> DataFrame:
    """The mix itself: id, source, ``repeat`` (from 0) and text, a row each time a document is taken. A text that is cut ends with a word."""
    rows = docs.select(
        F.col(quoted(id_column)).alias("id"), F.col(quoted(source)).cast("string").alias("source"), text_of(text).alias("text"))
    rows = held(rows, size=n_words(F.col("text")), hash=place(F.col("id"), F.col("text")))
    table = thresholds(stored(rows.select("id", "source", "size", "hash"), "sizes"), weights, share, most)
    given = held(by_source(rows, table, table.count()), words=taken()).where("words > 0")
    given = given.select("id", "source", "text", "size", "words", F.explode(F.sequence(F.lit(0), F.expr("int((words - 1) div size)"))).alias("repeat"))
    here = F.least(F.col("size"), F.col("words") - F.col("repeat") * F.col("size")).cast("int")
    parts = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(parts, F.lit(1), here), "")
    return given.select(
        F.col("id").alias(id_column), F.col("source").alias(source), "repeat",
        F.when(here == F.col("size"), F.col("text")).otherwise(cut).alias(text))
