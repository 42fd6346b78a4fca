"""Packing, unpacking and conforming record values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellflow.functions import as_column


class SchemaMismatch(TypeError):
    """A value does not have the declared type."""


def pack(rows: DataFrame, fields: Sequence[str], into: str) -> DataFrame:
    """Add one record made of the fields, which stay."""
    return rows.withColumn(into, F.struct(*fields))


def unpack(rows: DataFrame, packed: str, into: Sequence[str], by_name: bool = False) -> DataFrame:
    """Add the top-level fields of a record under new names, by position (P10).

    With ``by_name`` the names are those of record fields and may leave some out.
    """
    dtype = rows.schema[packed].dataType
    if not isinstance(dtype, T.StructType):
        raise SchemaMismatch(f"{packed} is {dtype.simpleString()}, not a record")
    if by_name:
        lost = [n for n in into if n not in dtype.names]
        if lost:
            raise SchemaMismatch(f"{packed} has no field {', '.join(lost)}")
        names = list(into)
    else:
        if len(into) != len(dtype.names):
            raise SchemaMismatch(f"{packed} has {len(dtype.names)} fields, {len(into)} names given")
        names = dtype.names
    return rows.select("*", *[F.col(packed).getField(n).alias(o) for n, o in zip(names, into)])


def require_type(rows: DataFrame, column: str, expected: str | T.DataType) -> Column:
    """The column, if it has exactly this type: nothing is coerced (C4)."""
    expected = expected if isinstance(expected, T.DataType) else T.DataType.fromDDL(expected)
    actual = rows.select(column).schema[0].dataType
    if not same_type(actual, expected):
        raise SchemaMismatch(f"{column} is {actual.simpleString()}, not {expected.simpleString()}")
    return F.col(column)


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal up to nullability."""
    return a.simpleString() == b.simpleString()


def conform(value: str | Column, actual: T.DataType, declared: T.DataType, where: str = "value") -> Column:
    """Rebuild a value with a declared schema (K6).

    Types must be exactly the declared ones (an int is not widened), record fields beyond the
    declared ones are dropped, a missing one is an error. All of it is decided from the schemas
    before a job starts.
    """
    value = as_column(value)
    if isinstance(actual, T.NullType):
        return value.cast(declared)
    if isinstance(declared, T.StructType) and isinstance(actual, T.StructType):
        lost = [n for n in declared.names if n not in actual.names]
        if lost:
            raise SchemaMismatch(f"{where} lacks the field {', '.join(lost)}")
        parts = [
            conform(value.getField(f.name), actual[f.name].dataType, f.dataType, f"{where}.{f.name}").alias(f.name)
            for f in declared.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(declared, T.ArrayType) and isinstance(actual, T.ArrayType):
        if same_type(actual, declared):
            return value
        return F.transform(value, lambda x: conform(x, actual.elementType, declared.elementType, f"{where}[]"))
    if isinstance(declared, T.MapType) and isinstance(actual, T.MapType):
        if same_type(actual, declared):
            return value
        if not same_type(actual.keyType, declared.keyType):
            raise SchemaMismatch(f"{where} has {actual.keyType.simpleString()} keys")
        return F.transform_values(value, lambda k, x: conform(x, actual.valueType, declared.valueType, f"{where}{{}}"))
    if not same_type(actual, declared):
        raise SchemaMismatch(f"{where} is {actual.simpleString()}, declared as {declared.simpleString()}")
    return value
