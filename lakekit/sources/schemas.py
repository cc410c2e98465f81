"""Schemas that differ between files: one common schema by widening types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text holds everything.

    Whole numbers widen to larger ones, whole numbers and decimals to a decimal that has all digits of both (to double beyond 38), either with a float or double to double,
    dates to timestamps. Arrays, maps and structs widen part by part; a struct has the fields of both.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    numeric = lambda t: type(t) in _WHOLE or isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType))
    if numeric(a) and numeric(b):
        as_decimal = lambda t: t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0)
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
            return T.DoubleType()
        x, y = as_decimal(a), as_decimal(b)
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return max(a, b, key=lambda t: times.index(type(t)))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType), a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    return T.StringType()


def merged(schemas: Iterable[T.StructType]) -> T.StructType:
    """One schema with the columns of all, in the order they are first seen; names are compared without regard to case."""
    found: dict[str, T.StructField] = {}
    for s in schemas:
        for f in s.fields:
            old = found.get(f.name.lower())
            found[f.name.lower()] = f if old is None else T.StructField(old.name, widest(old.dataType, f.dataType), True, old.metadata)
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in found.values()])
