"""Column helpers used by cell tables and models; everything else is a Spark built-in."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ, whatever the session time zone is."""
    return F.timestamp_diff("MICROSECOND", timestamp_of_micros(0), as_column(ts))


def timestamp_of_micros(version: int) -> Column:
    # A folded TIMESTAMP_NTZ constant: a plain datetime literal has a time zone, and comparing it
    # would convert the stored column and keep the filter away from the files.
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.lit(version).cast("bigint"), epoch)


def entity_id(*components: str | Column) -> Column:
    """A composite entity id (P11); compares component by component, shorter prefix first (O2)."""
    return F.struct(*[as_column(c).alias(f"c{i}") for i, c in enumerate(components)])


def component(eid: str | Column, index: int) -> Column:
    return as_column(eid).getField(f"c{index}")


def hashed_entity_id(*components: str | Column) -> Column:
    """A 16-byte id from which the components cannot be recovered.

    Every part is written with its length, and NULL as a mark of its own, so different ids are hashed from different texts.
    """
    texts = [as_column(c).cast("string") for c in components]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts]
    return F.unhex(F.md5(F.concat(*parts)))


def record(**fields: str | Column) -> Column:
    """A record value from named parts."""
    return F.struct(*[as_column(c).alias(n) for n, c in fields.items()])


def map_value(m: str | Column, key) -> Column:
    """The value of a key that must be there."""
    m, key = as_column(m), key if isinstance(key, Column) else F.lit(key)
    return F.when(F.map_contains_key(m, key), F.element_at(m, key)).otherwise(
        F.raise_error(F.concat(F.lit("no such map key: "), key.cast("string")))
    )


def list_value(a: str | Column, index: int) -> Column:
    """The element at a 0-based index that must be there."""
    a = as_column(a)
    return F.when((F.lit(index) >= 0) & (F.size(a) > index), F.get(a, F.lit(index))).otherwise(
        F.raise_error(F.lit(f"list index {index} out of range"))
    )


def words(text: str | Column) -> Column:
    """Split on white space."""
    return F.split(as_column(text), r"\s+")


def first_token(text: str | Column) -> Column:
    return F.get(words(text), F.lit(0))


def comma_joined(items: str | Column) -> Column:
    return F.array_join(as_column(items).cast("array<string>"), ",")


def dot(a: str | Column, b: str | Column) -> Column:
    """Sum of products of two equally long arrays."""
    products = F.zip_with(as_column(a), as_column(b), lambda x, y: x.cast("double") * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def scaled(a: str | Column, factor: Column) -> Column:
    """Every element times one number."""
    return F.transform(as_column(a), lambda x: x.cast("double") * factor)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    An expression named inside a lambda is computed again for every element; bound as a lambda variable it is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal_of(value: Any, dtype: T.DataType) -> Column:
    """A constant of a given type; records as tuples or dicts, lists and maps nested."""
    if isinstance(value, Column) or value is None:
        return F.lit(value).cast(dtype)
    if isinstance(dtype, T.StructType):
        parts = [value[n] for n in dtype.names] if isinstance(value, dict) else value
        return F.struct(*[literal_of(p, f.dataType).alias(f.name) for p, f in zip(parts, dtype.fields, strict=True)])
    if isinstance(dtype, T.ArrayType):
        return F.array(*[literal_of(v, dtype.elementType) for v in value]).cast(dtype)
    if isinstance(dtype, T.MapType):
        pairs = [c for k, v in value.items() for c in (literal_of(k, dtype.keyType), literal_of(v, dtype.valueType))]
        return F.create_map(*pairs).cast(dtype)
    return F.lit(value).cast(dtype)


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort values of this type: anything without a map in it."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True


def random_entity_id() -> Column:
    """A fresh id per imported row (C11). Not repeatable: write it before it is used twice."""
    return F.expr("uuid()")
