"""Column order for partitioned tables, and the order of rows inside a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costflow.sqltext import Projection, project, quote

#: Bits of a column's rank that take part in an interleaved order.
RANK_BITS = 6


def partition_last_items(schema: T.StructType, column: str = "partitiondate") -> Projection:
    others = [(f.name, quote(f.name)) for f in schema.fields if f.name != column]
    if len(others) == len(schema.fields):
        return others
    return others + [(column, f"CAST({quote(column)} AS DATE)")]


def partition_last(df: DataFrame, column: str = "partitiondate") -> DataFrame:
    """The partition column as a date behind all others; unchanged if there is none."""
    return project(df, partition_last_items(df.schema, column))


def column_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> dict[str, list]:
    """For each column the values that cut its rows into 2 ** `bits` parts of about equal size.

    One pass with quantile sketches, which add up over tasks; the bounds are all
    that reaches the driver. Equal bounds, as a frequent value leaves them, are one.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    quantiles = [F.percentile_approx(_number(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]
    row = df.agg(*quantiles).first()
    return {c: sorted(set(row[i] or [])) for i, c in enumerate(columns)}


def interleaved(df: DataFrame, columns: Sequence[str], bounds: dict[str, list], bits: int = RANK_BITS) -> Column:
    """A number whose bits are those of the columns' ranks in turn, the highest first.

    Rows with near numbers are near in every one of the columns, so a file of such
    rows spans little of each. Nulls rank lowest.
    """
    ranks = [_rank(_number(df, c), bounds[c], 2**bits) for c in columns]
    total = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            total = F.shiftleft(total, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")))
    return total


def cluster_by_all(df: DataFrame, columns: Sequence[str], partitions: int, partition_col: str | None = None, bits: int = RANK_BITS) -> DataFrame:
    """`df` in `partitions` tasks by ranges of (partition date, interleaved order of two or three columns).

    A file written from it holds a narrow range of each column, not only of the
    first one, so that the statistics in its footer let a filter on any of them
    leave it out. Ranges are cut by sampled weight: a date that holds many rows
    gets many tasks. Columns must be numbers, dates or timestamps.
    """
    order = "order of the layout"
    placed = df.withColumn(order, interleaved(df, columns, column_bounds(df, columns, bits), bits))
    first = [quote(partition_col)] if partition_col else []
    # The row's hash cuts where many rows share one place in the order.
    keys = [*first, quote(order), F.xxhash64(*(F.col(quote(c)) for c in columns))]
    return placed.repartitionByRange(partitions, *keys).sortWithinPartitions(*first, quote(order)).drop(order)


def _number(df: DataFrame, column: str) -> Column:
    """A value of the same order that a quantile sketch takes."""
    kind, value = df.schema[column].dataType, F.col(quote(column))
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.NumericType):
        return value
    raise ValueError(f"{column} is {kind.simpleString()}, not a number, date or timestamp")


def _rank(value: Column, bounds: Sequence, ranks: int) -> Column:
    """How many bounds lie below or at the value, stretched over all ranks where there are fewer bounds."""
    if not bounds:
        return F.lit(0).cast("long")
    below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= value))
    stretched = F.floor(below * ranks / (len(bounds) + 1)).cast("long")
    return F.when(value.isNull(), F.lit(0).cast("long")).otherwise(stretched)
