"""Lower-case column names."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from costflow.sqltext import Projection, literal, project, quote, require_unique


def lowercase_nested_items(
    schema: T.StructType, into_collections: bool = False, shallow: Collection[str] = ()
) -> Projection:
    """`shallow` names columns whose inside is left alone, since it is flattened next."""
    require_unique((f.name.lower() for f in schema.fields), "lower-case names")
    return [
        (
            f.name.lower(),
            quote(f.name)
            if f.name.lower() in shallow
            else renamed(quote(f.name), f.dataType, into_collections, f.name),
        )
        for f in schema.fields
    ]


def lowercase_nested(df: DataFrame, into_collections: bool = False) -> DataFrame:
    """Lower-case all top-level names and all names in structs, at any depth.

    A null struct stays null. Structs inside arrays and maps keep their names
    unless `into_collections` is set. Structs are rebuilt member by member, not
    cast as a whole, so the scan still reads only the members used later.
    """
    return project(df, lowercase_nested_items(df.schema, into_collections))


def lowercase_top_items(schema: T.StructType) -> Projection:
    require_unique((f.name.lower() for f in schema.fields), "lower-case names")
    return [(f.name.lower(), quote(f.name)) for f in schema.fields]


def lowercase_top(df: DataFrame) -> DataFrame:
    """Lower-case the top-level names only; names inside structs stay."""
    return project(df, lowercase_top_items(df.schema))


def renamed(
    value: str, dtype: T.DataType, into_collections: bool = False, path: str = "", depth: int = 0
) -> str:
    """SQL text of `value` with lower-case member names, null where `value` is null."""
    if not _has_upper_case(dtype, into_collections):
        return value
    if isinstance(dtype, T.StructType):
        require_unique((f.name.lower() for f in dtype.fields), f"lower-case names in {path}")
        members = ", ".join(
            f"{literal(f.name.lower())}, "
            + renamed(f"{value}.{quote(f.name)}", f.dataType, into_collections, f"{path}.{f.name}", depth)
            for f in dtype.fields
        )
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({members}) END"
    item = f"item{depth}"
    if isinstance(dtype, T.ArrayType):
        inner = renamed(item, dtype.elementType, into_collections, f"{path}[]", depth + 1)
        return f"transform({value}, {item} -> {inner})"
    inner = renamed(item, dtype.valueType, into_collections, f"{path}{{}}", depth + 1)
    return f"transform_values({value}, (key{depth}, {item}) -> {inner})"


def _has_upper_case(dtype: T.DataType, into_collections: bool) -> bool:
    if isinstance(dtype, T.StructType):
        return any(
            f.name != f.name.lower() or _has_upper_case(f.dataType, into_collections)
            for f in dtype.fields
        )
    if into_collections and isinstance(dtype, T.ArrayType):
        return _has_upper_case(dtype.elementType, into_collections)
    if into_collections and isinstance(dtype, T.MapType):
        return _has_upper_case(dtype.valueType, into_collections)
    return False
