"""One schema for files that disagree on types: the narrowest type that takes the values of all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from costflow.sqltext import Projection, literal, quote

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FLOATING = (T.FloatType, T.DoubleType)
_MAX_DIGITS = 38


class TypeConflict(ValueError):
    """Two types that no type covers."""


def widest(a: T.DataType, b: T.DataType, where: str = "column") -> T.DataType:
    """The narrowest type for the values of both.

    * equal types: that; void: the other
    * whole numbers: the longer; with decimals: a decimal with room for both, or a
      string where 38 digits do not do; with floating numbers: double
    * float and double, decimal and floating: double
    * date and a timestamp: that timestamp
    * string and any other simple type but binary: string
    * structs by member name, arrays and maps by element

    Anything else is a `TypeConflict` that names the column.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b], where)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType, f"{where}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType, f"{where} key"), widest(a.valueType, b.valueType, f"{where}{{}}"))
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if kinds <= {*_WHOLE, T.DecimalType}:
        return _decimal(a, b)
    if kinds <= {*_WHOLE, *_FLOATING, T.DecimalType}:
        return T.DoubleType()
    if kinds in ({T.DateType, T.TimestampType}, {T.DateType, T.TimestampNTZType}):
        return a if isinstance(b, T.DateType) else b
    if T.StringType in kinds and not kinds & {T.BinaryType, T.StructType, T.ArrayType, T.MapType}:
        return T.StringType()
    raise TypeConflict(f"{where}: {a.simpleString()} in some files, {b.simpleString()} in others")


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    whole, scale = zip(*((t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)), strict=True)
    digits = max(whole) + max(scale)
    return T.DecimalType(digits, max(scale)) if digits <= _MAX_DIGITS else T.StringType()


def merged(schemas: Sequence[T.StructType], where: str = "") -> T.StructType:
    """All columns of the schemas, each with its widest type, in the order in which they first occur.

    Names are the same if they differ in case only; the first spelling stays.
    """
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = fields.get(f.name.lower())
            path = f"{where}.{f.name}" if where else f.name
            kind = f.dataType if known is None else widest(known.dataType, f.dataType, path)
            fields[f.name.lower()] = T.StructField(f.name if known is None else known.name, kind)
    return T.StructType(list(fields.values()))


def widened_items(schema: T.StructType, wide: T.StructType) -> Projection:
    """Columns of `schema` as those of `wide`; what it lacks is null."""
    own = {f.name.lower(): f for f in schema.fields}
    return [(f.name, _widened(own.get(f.name.lower()), f.dataType, "")) for f in wide.fields]


def _widened(field: T.StructField | None, wide: T.DataType, parent: str) -> str:
    if field is None:
        return f"CAST(NULL AS {wide.simpleString()})"
    value = f"{parent}{quote(field.name)}"
    return _cast(value, field.dataType, wide)


def _cast(value: str, given: T.DataType, wide: T.DataType, depth: int = 0) -> str:
    if given == wide:
        return value
    if isinstance(given, T.StructType):
        own = {f.name.lower(): f for f in given.fields}
        members = []
        for f in wide.fields:
            m = own.get(f.name.lower())
            sql = f"CAST(NULL AS {f.dataType.simpleString()})" if m is None else _cast(f"{value}.{quote(m.name)}", m.dataType, f.dataType, depth)
            members.append(f"{literal(f.name)}, {sql}")
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({', '.join(members)}) END"
    item = f"item{depth}"
    if isinstance(given, T.ArrayType):
        return f"transform({value}, {item} -> {_cast(item, given.elementType, wide.elementType, depth + 1)})"
    if isinstance(given, T.MapType):
        keys = f"transform_keys({value}, ({item}, v{depth}) -> {_cast(item, given.keyType, wide.keyType, depth + 1)})"
        return f"transform_values({keys}, (k{depth}, {item}) -> {_cast(item, given.valueType, wide.valueType, depth + 1)})"
    return f"CAST({value} AS {wide.simpleString()})"
