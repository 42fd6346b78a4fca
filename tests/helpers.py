from pyspark.sql import functions as F

from cellflow.functions import as_column
from cellflow.sources.cells import CellTable, LongCells, Version


def cell_view(spark, family, rows, value_type="string", qualifiers=None, ordered=False):
    """rows: (entity, qualifier, version, value[, order])."""
    schema = f"entity string, qualifier string, version bigint, value {value_type}"
    frame = spark.createDataFrame(rows, schema + (", ord bigint" if ordered else ""))
    return LongCells(
        frame,
        family,
        {"entity": "entity"},
        "qualifier",
        Version.number("version"),
        "value",
        "ord" if ordered else None,
        qualifiers,
    )


def cell_table(*views):
    return CellTable(["entity"], views)


def slices(frame, *fields):
    """{entity: slice as list of (qualifier, version, value)} (or a tuple of slices)."""
    out = {}
    for row in frame.collect():
        got = [None if row[f] is None else [tuple(c) for c in row[f]] for f in fields]
        out[row["entity"]] = got[0] if len(fields) == 1 else tuple(got)
    return out


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def literal_slice(cells, value_type="double"):
    """A slice Column from (qualifier, version, value) tuples."""
    typed = f"array<struct<qualifier:string,version:bigint,value:{value_type}>>"
    parts = [
        F.struct(F.lit(q).alias("qualifier"), F.lit(v).alias("version"), as_column(F.lit(x)).alias("value"))
        for q, v, x in cells
    ]
    return F.array(*parts).cast(typed)
