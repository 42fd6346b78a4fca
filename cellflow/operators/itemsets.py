"""Item sets of baskets and filtering by support."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.functions import as_column, comma_joined
from cellflow.operators.joins import cross_with_row, skewed_join
from cellflow.session import written

FREQUENCY = "itemSetFrequency"
SPLIT_ABOVE = 1000


def item_sets(
    baskets: DataFrame,
    basket: str | Column,
    out: str,
    min_size: int = 2,
    max_size: int = 5,
    joined: bool = True,
    split_above: int | None = SPLIT_ABOVE,
) -> DataFrame:
    """Every subset of ``min_size``..``max_size`` items of each basket, one row each.

    Baskets are arrays and keep repeated items: ``a, b, b`` holds ``a,b`` and ``b,b`` once each. The
    sorted basket is expanded by one generator per item, so no subset list is ever held in memory
    and nothing is shuffled, but for baskets of more than ``split_above`` items: their sets are
    spread by first item. Give None where baskets are known to be smaller, which saves a second pass
    over them. ``joined`` gives comma-joined text, otherwise the array.
    """
    if not 1 <= min_size <= max_size:
        raise ValueError(f"set sizes must satisfy 1 <= {min_size} <= {max_size}")
    items = as_column(basket)
    rows = baskets.where(F.size(items) >= min_size).select(
        F.sort_array(items).alias("_items"), (F.size(F.array_distinct(items)) == F.size(items)).alias("_unique")
    )
    rows = rows.withColumn("_at", F.lit(0))
    if split_above is None or max_size == 1:
        sets = _expand(rows, min_size, max_size, spread=False)
    else:
        large = F.size("_items") > split_above
        sets = _expand(rows.where(~large), min_size, max_size, spread=False)
        sets = sets.union(_expand(rows.where(large), min_size, max_size, spread=True))
    return sets.select((comma_joined("_set") if joined else F.col("_set")).alias(out))


def _expand(rows: DataFrame, min_size: int, max_size: int, spread: bool) -> DataFrame:
    for size in range(1, max_size + 1):
        so_far = [] if size == 1 else [F.col("_set")]
        rows = rows.select(
            "_items", "_unique", *so_far, F.explode(_next_positions(max(min_size - size, 0), size > min_size)).alias("_at")
        )
        added = F.array(F.try_element_at("_items", F.col("_at")))
        if size > min_size:
            grown = F.when(F.col("_at") > F.size("_items"), F.col("_set")).otherwise(F.concat("_set", added))
        else:
            grown = F.concat("_set", added) if so_far else added
        rows = rows.select("_items", "_unique", "_at", grown.alias("_set"))
        if spread and size == 1:
            rows = rows.repartition(F.hash(F.get("_items", F.lit(0)), F.size("_items"), F.col("_at")))
    return rows.select("_set")


def _next_positions(still_needed: int, may_stop: bool) -> Column:
    """Positions of the next item after ``_at``, each distinct item once, leaving room for the items
    ``still_needed`` after it. One position past the end stands for stopping here."""
    start, last = F.col("_at") + 1, F.size("_items") - still_needed
    later = F.when(start <= last, F.sequence(start, last)).otherwise(F.array().cast("array<int>"))

    def first_of_its_kind(p: Column) -> Column:
        before = F.try_element_at("_items", F.greatest(p - 1, F.lit(1)))
        return (p == start) | (F.element_at("_items", p) != before)

    # Only a basket with repeated items needs the check.
    distinct = F.when(F.col("_unique"), later).otherwise(F.filter(later, first_of_its_kind))
    return F.concat(F.array(F.size("_items") + 1), distinct) if may_stop else distinct


def capped_counts(rows: DataFrame, basket: Sequence[str], item: str, max_size: int) -> DataFrame:
    """Items per basket with their multiplicity, at most ``max_size``: more copies of an item cannot
    appear in one set, so no set is lost."""
    counted = rows.groupBy(*basket, item).agg(F.count(F.lit(1)).alias("_n"))
    # Every count is positive; asking for it keeps the count in each use of the result, so that the
    # uses are the same plan up to here and share one exchange.
    return counted.withColumn("_n", F.least(F.col("_n"), F.lit(max_size)).cast("int")).where(F.col("_n") > 0)


def gather_baskets(counted: DataFrame, basket: Sequence[str], item: str, out: str) -> DataFrame:
    """Basket arrays from distinct items with multiplicities: bounded by the number of items."""
    copies = F.array_repeat(F.col(item), F.col("_n"))
    return counted.groupBy(*basket).agg(F.flatten(F.collect_list(copies)).alias(out))


def filter_by_support(
    sets: DataFrame,
    itemset: str,
    support: str,
    threshold: float,
    constant: float | None = None,
    normalizer: DataFrame | None = None,
    normalizer_field: str = "normalizer",
) -> DataFrame:
    """Frequency of every item set, divided by a normaliser; keeps support above the threshold.

    Give exactly one of ``constant`` and a one-row ``normalizer`` frame with ``normalizer_field``.
    Frequencies are counted before and after one exchange, whose size Spark adapts when it runs.
    """
    if (constant is None) == (normalizer is None):
        raise ValueError("give exactly one of a constant and a normalizer frame")
    counts = sets.groupBy(itemset).agg(F.count(F.lit(1)).alias(FREQUENCY))
    if constant is not None:
        counts = counts.withColumn(normalizer_field, F.lit(float(constant)))
    else:
        counts = cross_with_row(counts, normalizer.select(normalizer_field))
    ratio = F.try_divide(F.col(FREQUENCY).cast("double"), F.col(normalizer_field).cast("double"))
    return counts.withColumn(support, ratio).where(F.col(support) > threshold)


def frequent_item_sets(
    rows: DataFrame,
    basket: Sequence[str],
    item: str,
    threshold: float,
    min_size: int = 2,
    max_size: int = 5,
    constant: float | None = None,
    normalizer: DataFrame | None = None,
    out: str = "itemset",
    support: str = "support",
) -> DataFrame:
    """Item sets with support above the threshold, straight from (basket, item) rows.

    The normaliser is ``constant``, the only value of a one-row ``normalizer``, or else the number of
    baskets. Sets grow level by level: an item that is not itself above the threshold goes before any basket is gathered, and a
    set grows only while it is frequent, by items with which its other items are frequent as well. A row carries a set and the items
    of its basket that may follow, so the sets of a large basket are grown by many tasks. Each level is written once,
    for it is counted and then grown.
    """
    if threshold < 0:
        raise ValueError("the threshold must not be negative")
    if not 1 <= min_size <= max_size:
        raise ValueError(f"set sizes must satisfy 1 <= {min_size} <= {max_size}")
    basket = list(basket)
    counted = written(capped_counts(rows, basket, item, max_size), "items")
    if constant is not None:
        total = float(constant)
    elif normalizer is not None:
        total = normalizer.select(F.col(normalizer.columns[0]).cast("double")).first()[0]
    else:
        total = float(counted.select(*basket).distinct().count())
    ratio = F.try_divide(F.col("_rows").cast("double"), F.lit(total))
    supports = counted.groupBy(item).agg(F.count(F.lit(1)).alias("_rows"))
    frequent = supports.where(ratio > threshold)
    kept = skewed_join(counted, frequent, [item], "left_semi", counts=supports, right_knows="_rows")
    found = [frequent.select(F.array(item).alias("_set"), "_rows")] if min_size == 1 else []
    sorted_items = gather_baskets(kept, basket, item, "_items").select(F.sort_array("_items").alias("_tail"))
    level = _grow(sorted_items.where(F.size("_tail") >= max(min_size, 2)).withColumn("_set", F.array().cast(sorted_items.schema["_tail"].dataType)))
    level = level.repartition(F.xxhash64("_set", "_tail"))
    known = None
    for size in range(2, max_size + 1):
        grown = _grow(level)
        if known is not None:  # the set without its last but one item
            other = F.concat(F.slice("_set", 1, size - 2), F.slice("_set", size, 1))
            grown = skewed_join(grown.withColumn("_other", other), known.withColumnRenamed("_set", "_other"), ["_other"], "left_semi").drop("_other")
        grown = written(grown, "sets")
        counts = grown.groupBy("_set").agg(F.count(F.lit(1)).alias("_rows"))
        known = written(counts.where(ratio > threshold), "frequent")
        if size >= min_size:
            found.append(known)
        if size < max_size:
            if known.isEmpty():
                break
            level = skewed_join(grown.where(F.size("_tail") > 0), known, ["_set"], "left_semi", counts=counts, right_knows="_rows")
    sets = reduce(DataFrame.unionByName, found) if found else known.where(F.lit(False))
    return sets.select(comma_joined("_set").alias(out), F.col("_rows").alias(FREQUENCY), ratio.alias(support))


def _grow(rows: DataFrame) -> DataFrame:
    """Every set with one more of the items that may follow, each distinct one once."""
    first = F.transform("_tail", lambda x, i: F.when((i > 0) & (F.get("_tail", i - 1) == x), None).otherwise(i))
    rows = rows.select("_set", "_tail", F.explode(F.array_compact(first)).alias("_at"))
    return rows.select(
        F.concat("_set", F.slice("_tail", F.col("_at") + 1, F.lit(1))).alias("_set"),
        F.slice("_tail", F.col("_at") + 2, F.size("_tail")).alias("_tail"))
