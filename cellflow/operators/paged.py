"""Slice functions over slices of any length, page by page (S1-S9 on A9).

The array forms of ``operators.slices`` work on one value of one row. These work on the pages of ``scan_pages``: each page gives a small
state in its own task, and the states of an entity are merged, in the order of pages where order matters. No task holds more than a page, so an entity
may have any number of cells. Results are those of the array forms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.session import written

#: States that one task merges at a time.
FAN = 64


def first_of_pages(pages: DataFrame, entity: Sequence[str], out: str = "first") -> DataFrame:
    """The first cell of every entity's slice, in canonical order."""
    cell = pages.select(*entity, "page", F.get("cells", F.lit(0)).alias("_cell"))
    return cell.groupBy(*entity).agg(F.min_by("_cell", "page").alias(out))


def last_of_pages(pages: DataFrame, entity: Sequence[str], out: str = "last") -> DataFrame:
    cell = pages.select(*entity, "page", F.element_at("cells", -1).alias("_cell"))
    return cell.groupBy(*entity).agg(F.max_by("_cell", "page").alias(out))


def page_stats(pages: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Per entity ``n``, ``sum``, ``mean``, ``min``, ``max`` and the population ``variance`` of the values."""
    values = F.transform("cells", lambda c: c.value.cast("double"))
    # a page's values around its own mean, so that large values do not cancel
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)
    told = pages.select(
        *entity, F.size("cells").cast("bigint").alias("_n"), F.array_min(values).alias("_min"), F.array_max(values).alias("_max"),
        mean.alias("_mean"), values.alias("_values"))
    told = told.withColumn("_m2", F.aggregate("_values", F.lit(0.0), lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean"))))
    total = F.sum(F.col("_n") * F.col("_mean"))
    sums = told.groupBy(*entity).agg(
        F.sum("_n").alias("n"), total.alias("sum"), F.min("_min").alias("min"), F.max("_max").alias("max"), F.sum("_m2").alias("_inner"),
        # between pages: the variance of their means, each as often as it has cells
        F.sum(F.col("_n") * F.col("_mean") * F.col("_mean")).alias("_squares"))
    between = F.greatest(F.col("_squares") - F.col("sum") * F.col("sum") / F.col("n"), F.lit(0.0))
    return sums.select(
        *entity, "n", "sum", (F.col("sum") / F.col("n")).alias("mean"), "min", "max", ((F.col("_inner") + between) / F.col("n")).alias("variance"))


def group_pages(pages: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Slices by qualifier, as pages again: (entity, qualifier, page, cells), numbered from 0 in each group. A group that goes over several pages has
    a piece of each, so pieces are no larger than pages."""
    groups = F.transform(
        F.array_distinct(F.transform("cells", lambda c: c.qualifier)),
        lambda q: F.struct(q.alias("qualifier"), F.filter("cells", lambda c: c.qualifier.eqNullSafe(q)).alias("cells")))
    pieces = pages.select(*entity, F.col("page").alias("_page"), F.inline(groups))
    # cells are ordered by qualifier, so a group's pages follow each other
    first = pieces.groupBy(*entity, "qualifier").agg(F.min("_page").alias("_first"))
    numbered = written(pieces, "pieces").join(written(first, "groups"), [*entity, "qualifier"])
    return numbered.select(*entity, "qualifier", (F.col("_page") - F.col("_first")).alias("page"), "cells")


def fold_pages(
    pages: DataFrame,
    entity: Sequence[str],
    page_state: Callable[[Column], Column],
    merge: Callable[[Column, Column], Column],
    out: str,
    finish: Callable[[Column], Column] = lambda state: state,
) -> DataFrame:
    """An ordered fold of every slice: (entity, ``out``).

    ``page_state`` makes the state of a page from its cells, ``merge`` one state of two that follow each other; it must be associative and
    need not be commutative. Rounds of FAN neighbouring pages are merged until each entity has one, so their number follows the logarithm of
    the largest number of pages.
    """
    states = written(pages.select(*entity, "page", page_state(F.col("cells")).alias("_state")), "states")
    most = states.agg(F.max("page")).first()[0]
    while most:
        run = states.groupBy(*entity, F.expr(f"page div {FAN}").alias("_run")).agg(F.sort_array(F.collect_list(F.struct("page", "_state"))).alias("_in_order"))
        rest = F.slice("_in_order", F.lit(2), F.size("_in_order"))
        merged = F.aggregate(rest, F.get("_in_order", F.lit(0))._state, lambda state, p: merge(state, p._state))
        states = written(run.select(*entity, F.col("_run").alias("page"), merged.alias("_state")), "states")
        most //= FAN
    return states.select(*entity, finish(F.col("_state")).alias(out))
