"""Joins that hold up when one key owns a large share of the rows, and joins with counts."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.functions import orderable

# A key is heavy when it has more rows than one task should join: ROWS_PER_TASK, or 1/MOST_HEAVY of all
# rows if that is more. So there are fewer than MOST_HEAVY heavy keys whatever the data, which is the
# proven bound of what is broadcast here, and together they are cut in fewer than 2 * MOST_HEAVY parts.
ROWS_PER_TASK = 2_000_000
MOST_HEAVY = 50_000
# Counters of the summary of frequent keys. Its counts are off by at most about 1/7,500 of all rows, so with that many rows or more no
# heavy key is missed, and one that is has no more rows than a task of such a table anyway.
TRACKED = 10_000

BROADCAST_SETTING = "spark.sql.autoBroadcastJoinThreshold"
UNITS = {unit: 1 << (10 * i) for i, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"))}


def key_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def heavy_keys(counts: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Heavy keys, and in ``_parts`` how many tasks their rows should be spread over."""
    limit = _task_limit(counts, rows_per_task)
    return counts.where(F.col("_rows") > limit).select(*keys, _parts(F.col("_rows"), limit).alias("_parts"))


def frequent_keys(rows: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Heavy keys by their hash: (``_hash``, ``_parts``), at most TRACKED of them.

    One aggregate with a mergeable summary of bounded size: tasks count their own rows, and neither rows nor distinct keys are exchanged.
    Keys with the same hash are spread alike, which does no harm.
    """
    summary = rows.select(F.xxhash64(*keys).alias("_hash")).agg(
        F.call_function("approx_top_k", F.col("_hash"), F.lit(TRACKED), F.lit(TRACKED)).alias("_top"), F.count(F.lit(1)).alias("_all"))
    limit = F.greatest(F.lit(float(rows_per_task)), F.col("_all") / F.lit(float(MOST_HEAVY)))
    counted = summary.select(limit.alias("_limit"), F.explode("_top").alias("_key")).where(F.col("_key.count") > F.col("_limit"))
    return counted.select(F.col("_key.item").alias("_hash"), _parts(F.col("_key.count"), F.col("_limit")).alias("_parts"))


def _task_limit(counts: DataFrame, rows_per_task: int) -> Column:
    total = counts.agg(F.sum("_rows")).scalar()
    return F.greatest(F.lit(float(rows_per_task)), total / F.lit(float(MOST_HEAVY)))


def _parts(rows: Column, limit: Column) -> Column:
    return F.when(rows > limit, F.ceil(rows / limit)).otherwise(F.lit(1)).cast("int")


def row_hash(rows: DataFrame) -> Column:
    """A number that a re-run task gives again: it depends on the row and on the partition, not on
    chance. The partition id spreads rows that are equal in every column."""
    columns = [f.name for f in rows.schema.fields if orderable(f.dataType)]  # neither sorts nor hashes maps
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns]) + F.spark_partition_id()


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> tuple[DataFrame, Column]:
    """Rename the right keys and compare null-safely, so NULL keys meet NULL keys."""
    renamed = right.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})
    return renamed, reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def skewed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    right_knows: str | None = None,
) -> DataFrame:
    """Join with a side that has few rows per key while ``left`` may have very many.

    Heavy keys of ``left`` are found by a mergeable summary (one aggregate, then one small broadcast); their rows are spread
    over as many tasks as their number asks for, and their right rows repeated there. All other keys join as usual, so
    Spark still broadcasts the right side when it turns out small. ``how`` is inner, left, left_semi or left_anti; NULL keys match.

    The summary reads ``left`` once more, with the key columns only: pass ``counts`` (keys and ``_rows``) when they are
    known, and in ``right_knows`` the column of ``right`` that holds the number of left rows of its key, if there is one.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skewed_join cannot do a {how} join")
    keys = list(on)
    heavy = frequent_keys(left, keys, rows_per_task) if counts is None else heavy_keys(counts, keys, rows_per_task)

    def marked(frame: DataFrame) -> DataFrame:
        if counts is None:
            return frame.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(heavy), "_hash", "left")
        marks, same = _match(frame, heavy, keys, "_h_")
        return frame.join(F.broadcast(marks), same, "left")

    part = F.when(F.col("_parts").isNotNull(), F.pmod(row_hash(left), F.col("_parts"))).otherwise(F.lit(0))
    spread = marked(left).select(*left.columns, part.cast("int").alias("_part"))
    if right_knows is None:
        known = marked(right)
    elif counts is None:
        raise ValueError("right_knows goes with counts")
    else:
        known = right.withColumn("_parts", _parts(F.col(right_knows), _task_limit(counts, rows_per_task)))
    every_part = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    copies = known.select(*right.columns, F.explode(every_part).alias("_part"))
    copies, same = _match(spread, copies, [*keys, "_part"], "_r_")
    joined = spread.join(copies, same, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_part")
    extra = [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *extra)


def join_with_group_count(rows: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Every row with the number of rows sharing its key.

    Count and join instead of a window: a window would bring a hot group into one task.
    """
    keys = list(keys)
    counts = key_counts(rows, keys)
    joined = skewed_join(rows, counts, keys, counts=counts, right_knows="_rows")
    return joined.withColumnRenamed("_rows", out)


def join_with_count(rows: DataFrame, out: str) -> DataFrame:
    """Every row with the total number of rows (D8): a partial count and one scalar, no exchange of
    the rows."""
    return rows.withColumn(out, rows.agg(F.count(F.lit(1))).scalar())


def cross_with_row(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every row with the columns of a one-row frame (D5); more than one row fails, none gives none."""
    only = one_row.select(F.struct(*one_row.columns)).scalar()
    tagged = rows.withColumn("_only", only).where(F.col("_only").isNotNull())
    return tagged.select(*rows.columns, "_only.*")


def estimated_bytes(frame: DataFrame) -> int | None:
    """Spark's estimate of a frame's size, from the sizes of its files and its plan. No job runs."""
    told = frame.sparkSession.sql("EXPLAIN COST SELECT * FROM {frame}", frame=frame).first()[0]
    found = re.search(r"sizeInBytes=([\d.E+]+) (\w+)", told)
    return int(float(found[1]) * UNITS[found[2]]) if found and found[2] in UNITS else None


def broadcasts(frame: DataFrame) -> bool:
    """Whether Spark will broadcast this side of a join by its own size check, as far as can be told before a job."""
    setting = frame.sparkSession.conf.get(BROADCAST_SETTING)
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", setting.strip().lower()).groups()
    limit = int(number) * (1 << (10 * "bkmgtp".index(unit[0])) if unit else 1)
    size = estimated_bytes(frame)
    return size is not None and size <= limit


def is_small(side: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> bool:
    """Measure whether a frame is safe to broadcast; reads at most ``max_rows`` + 1 rows."""
    width = F.octet_length(F.to_json(F.struct(*side.columns)))
    n, size = side.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes
