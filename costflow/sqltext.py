"""Projections as (name, SQL expression) pairs.

Every projection operator builds one such list. The DataFrame form applies it
with `selectExpr`, the SQL form prints it into a view, so the two cannot drift.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

Projection = list[tuple[str, str]]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def require_unique(names: Iterable[str], where: str) -> None:
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"{where}: these names would occur more than once: {clashes}")


def select_list(projection: Projection) -> list[str]:
    return [f"{sql} AS {quote(name)}" for name, sql in projection]


def project(df: DataFrame, projection: Projection) -> DataFrame:
    return df.selectExpr(*select_list(projection))


def select_statement(projection: Projection, relation: str) -> str:
    items = ",\n  ".join(select_list(projection))
    return f"SELECT\n  {items}\nFROM {relation}"


def one_row(spark: SparkSession, **values: tuple[str, object]) -> DataFrame:
    """A row of `name=(type, value)`, planned in the JVM without a Python job."""
    items = ", ".join(f"CAST(:{name} AS {kind}) AS {quote(name)}" for name, (kind, _) in values.items())
    return spark.sql(f"SELECT {items}", args={name: value for name, (_, value) in values.items()})
