"""Slice operators (S1-S19) as Column functions, and the same statistics on long cells.

A slice is ``ARRAY<STRUCT<qualifier, version, value>>``. Functions taking ``value`` accept a Column
lambda over the cell, e.g. ``slice_sum(s, lambda c: c.value * 2)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.functions import as_column, let

CellFn = Callable[[Column], Column]


def _value(cell: Column) -> Column:
    return cell.getField("value")


def _numbers(s: str | Column, value: CellFn) -> Column:
    return F.transform(as_column(s), lambda c: value(c).cast("double"))


def first_cell(s: str | Column) -> Column:
    """Fails on an empty slice."""
    return F.element_at(as_column(s), 1)


def last_cell(s: str | Column) -> Column:
    return F.element_at(as_column(s), -1)


def first_value(s: str | Column) -> Column:
    return first_cell(s).getField("value")


def last_value(s: str | Column) -> Column:
    return last_cell(s).getField("value")


def first_value_or_null(s: str | Column) -> Column:
    return F.try_element_at(as_column(s), F.lit(1)).getField("value")


def values(s: str | Column) -> Column:
    """All values in slice order (S3)."""
    return F.transform(as_column(s), _value)


def order_by(s: str | Column, key: CellFn, descending: bool = False) -> Column:
    """Stable order by any orderable key."""
    before, after = (1, -1) if descending else (-1, 1)

    def compare(a: Column, b: Column) -> Column:
        x, y = key(a), key(b)
        return F.when(x < y, before).when(x > y, after).otherwise(0)

    return F.array_sort(as_column(s), compare)


def order_with(s: str | Column, comparator: Callable[[Column, Column], Column]) -> Column:
    """Stable order by a comparator giving a negative, zero or positive number."""
    return F.array_sort(as_column(s), comparator)


def chronological(s: str | Column) -> Column:
    return order_by(s, lambda c: c.version)


def reverse_chronological(s: str | Column) -> Column:
    return order_by(s, lambda c: c.version, descending=True)


def by_qualifier(s: str | Column) -> Column:
    return order_by(s, lambda c: c.qualifier)


def group_cells(s: str | Column, key: CellFn) -> Column:
    """Map from key to sub-slice, cell order kept (S8). Long cells group with a plain groupBy.

    The cells' places are sorted by key and cut into runs, so the work grows with the cells and not with cells times keys.
    """

    def runs(cells: Column) -> Column:
        places = F.array_sort(F.transform(cells, lambda c, i: F.struct(key(c).alias("key"), i.alias("at"))))
        return let(places, lambda p: let(_run_starts(p), lambda starts: F.map_from_entries(F.transform(
            starts, lambda b, j: F.struct(
                F.get(p, b)["key"].alias("key"),
                F.transform(
                    F.slice(p, b + 1, F.coalesce(F.get(starts, j + 1), F.size(p)) - b), lambda x: F.get(cells, x["at"])
                ).alias("value"))))))

    return let(as_column(s), runs)


def _run_starts(sorted_places: Column) -> Column:
    """Where a new key begins, from 0."""
    firsts = F.transform(sorted_places, lambda x, i: F.when(
        (i > 0) & F.get(sorted_places, i - 1)["key"].eqNullSafe(x["key"]), None).otherwise(i))
    return F.array_compact(firsts)


def group_by_qualifier(s: str | Column) -> Column:
    return group_cells(s, lambda c: c.qualifier)


def slice_size(s: str | Column) -> Column:
    return F.size(as_column(s))


def slice_sum(s: str | Column, value: CellFn = _value) -> Column:
    """Sum of the values; 0.0 for an empty slice."""
    return F.aggregate(_numbers(s, value), F.lit(0.0), lambda acc, x: acc + x)


def slice_sum_squares(s: str | Column, value: CellFn = _value) -> Column:
    return F.aggregate(_numbers(s, value), F.lit(0.0), lambda acc, x: acc + x * x)


def slice_avg(s: str | Column, value: CellFn = _value) -> Column:
    """Average; NULL for an empty slice."""
    return F.try_divide(slice_sum(s, value), F.size(as_column(s)).cast("double"))


def slice_variance(s: str | Column, value: CellFn = _value) -> Column:
    """Population variance; NULL for an empty slice."""
    numbers = _numbers(s, value)
    off = let(slice_avg(s, value), lambda mean: F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)))
    return F.try_divide(off, F.size(as_column(s)).cast("double"))


def slice_stddev(s: str | Column, value: CellFn = _value) -> Column:
    return F.sqrt(slice_variance(s, value))


def slice_min(s: str | Column, value: CellFn = _value) -> Column:
    """Least value as a double, NaN ignored."""
    return F.array_min(F.filter(_numbers(s, value), lambda x: ~F.isnan(x)))


def slice_max(s: str | Column, value: CellFn = _value) -> Column:
    return F.array_max(F.filter(_numbers(s, value), lambda x: ~F.isnan(x)))


def fold(s: str | Column, initial: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Left fold over the cells; ``step(acc, cell)``."""
    return F.aggregate(as_column(s), initial, step)


def same_slice(a: str | Column, b: str | Column) -> Column:
    """Same cells in the same order."""
    return as_column(a) == as_column(b)


def cell_stats(cells: DataFrame, by: Sequence[str], value: str | Column = "value") -> DataFrame:
    """Statistics of long cells per group with partial aggregation: no slice is built."""
    x = as_column(value).cast("double")
    number = F.nanvl(x, F.lit(None).cast("double"))
    return cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("size"),
        F.coalesce(F.sum(x), F.lit(0.0)).alias("sum"),
        F.coalesce(F.sum(x * x), F.lit(0.0)).alias("sum_squares"),
        F.avg(x).alias("avg"),
        F.var_pop(x).alias("variance"),
        F.stddev_pop(x).alias("stddev"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
    )
