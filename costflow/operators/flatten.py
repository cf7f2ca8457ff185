"""Cost structs to flat columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from costflow.operators.names import renamed
from costflow.sqltext import Projection, project, quote, require_unique

# The structs of the feed that are flattened.
COST_STRUCTS = ("costcurrencyvendorusd", "costcurrencyvendorraw")


def flatten_append_items(
    schema: T.StructType, structs: Sequence[str] = COST_STRUCTS, deep: bool = False
) -> Projection:
    flat = _struct_fields(schema, structs)
    kept = [(f.name, quote(f.name)) for f in schema.fields if f.name not in flat]
    new = [item for name in structs if name in flat for item in _members(flat[name], deep)]
    return _checked(kept + new)


def flatten_append(
    df: DataFrame, structs: Sequence[str] = COST_STRUCTS, deep: bool = False
) -> DataFrame:
    """Replace each named struct by `<struct>_<member>` columns at the end.

    Member names are lower-cased; `deep` also lower-cases the names of structs
    that are members themselves, which stay structs. A name that is absent or
    not a struct is left alone.
    """
    return project(df, flatten_append_items(df.schema, structs, deep))


def flatten_in_place_items(
    schema: T.StructType, structs: Sequence[str] = COST_STRUCTS, deep: bool = False
) -> Projection:
    flat = _struct_fields(schema, structs)
    items: Projection = []
    for f in schema.fields:
        items += _members(f, deep) if f.name in flat else [(f.name, quote(f.name))]
    return _checked(items)


def flatten_in_place(
    df: DataFrame, structs: Sequence[str] = COST_STRUCTS, deep: bool = False
) -> DataFrame:
    """As `flatten_append`, with the new columns where the struct stood."""
    return project(df, flatten_in_place_items(df.schema, structs, deep))


def _struct_fields(schema: T.StructType, structs: Sequence[str]) -> dict[str, T.StructField]:
    return {
        f.name: f for f in schema.fields if f.name in structs and isinstance(f.dataType, T.StructType)
    }


def _members(field: T.StructField, deep: bool) -> Projection:
    items = []
    for m in field.dataType.fields:
        value = f"{quote(field.name)}.{quote(m.name)}"
        items.append(
            (f"{field.name}_{m.name.lower()}", renamed(value, m.dataType) if deep else value)
        )
    return items


def _checked(items: Projection) -> Projection:
    require_unique((name for name, _ in items), "flattening")
    return items
