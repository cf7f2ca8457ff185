"""Columns to the types of a target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costflow.functions.epoch import epoch_sql
from costflow.operators.catalog import TargetSchema
from costflow.sqltext import Projection, literal, project, quote

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BROKEN = (T.DecimalType, T.DoubleType, T.FloatType)


def conform_items(
    schema: T.StructType,
    target: TargetSchema,
    *,
    missing: str = "ignore",
    extra: str = "keep",
    on_error: str = "fail",
    precision: str = "seconds",
    strict_epochs: bool = True,
) -> Projection:
    _require("missing", missing, ("ignore", "fill", "fail"))
    _require("extra", extra, ("keep", "drop", "fail"))
    _require("on_error", on_error, ("fail", "null"))
    types = target.types()
    present = {f.name for f in schema.fields}
    unknown = [f.name for f in schema.fields if f.name not in types]
    absent = [name for name in types if name not in present]
    if extra == "fail" and unknown:
        raise ValueError(f"columns outside the target schema: {unknown}")
    if missing == "fail" and absent:
        raise ValueError(f"target columns missing from the data: {absent}")

    items: Projection = []
    for f in schema.fields:
        if f.name in types:
            sql = _conformed(f, types[f.name], on_error, precision, strict_epochs)
            items.append((f.name, sql))
        elif extra == "keep":
            items.append((f.name, quote(f.name)))
    if missing == "fill":
        items += [(name, f"CAST(NULL AS {types[name].simpleString()})") for name in absent]
    return items


def conform(df: DataFrame, target: TargetSchema, **policies) -> DataFrame:
    """Cast every column to its target type; names must be lower case already.

    * timestamp target, whole-number source: `epoch_sql`
    * timestamp target, decimal or floating source: the same for whole values, null for others
    * timestamp target, text source: an all-digit text is an epoch, else a cast
    * any other type that differs: a cast
    * equal type: untouched

    `missing`: target columns the data lacks are left out ("ignore"), added as
    typed nulls at the end ("fill") or refused ("fail"). `extra`: data columns
    the target lacks are kept, dropped or refused. `on_error`: a value that does
    not fit fails the job or becomes null. `precision` and `strict_epochs` go to
    `epoch_sql`.
    """
    return project(df, conform_items(df.schema, target, **policies))


def column_profile(df: DataFrame, target: TargetSchema, **epochs) -> DataFrame:
    """(name, row_count, filled, rejected) per column of `df`, in one pass.

    `rejected` counts the values that are there but do not fit the target type.
    """
    types = target.types()
    counts = ["count(*) AS row_count"]
    rows = []
    # SQL text, as a wide table needs over a thousand of these expressions.
    for i, f in enumerate(df.schema.fields):
        value, rejected = quote(f.name), "0L"
        counts.append(f"count({value}) AS filled_{i}")
        if f.name in types and f.dataType != types[f.name]:
            fixed = _conformed(f, types[f.name], "null", **_epoch_options(epochs))
            rejected = f"filled_{i} - fitting_{i}"
            counts.append(f"count({fixed}) AS fitting_{i}")
        rows.append(
            f"named_struct('name', {literal(f.name)}, 'row_count', row_count, "
            f"'filled', filled_{i}, 'rejected', {rejected})"
        )
    return df.selectExpr(*counts).selectExpr(f"inline(array({', '.join(rows)}))")


def cast_rejects(df: DataFrame, target: TargetSchema, **epochs) -> DataFrame:
    """(name, target_type, filled, rejected) for the columns the target knows."""
    wanted = df.sparkSession.createDataFrame(
        [(name, dtype.simpleString()) for name, dtype in target.types().items()],
        "name string, target_type string",
    )
    return (
        column_profile(df, target, **epochs)
        .join(wanted, "name")
        .select("name", "target_type", "filled", "rejected")
    )


def schema_report(df: DataFrame, target: TargetSchema, profile: bool = False) -> DataFrame:
    """(name, source_type, target_type, status) for every column of either side.

    Status is `missing` (target only), `extra` (data only), `epoch`, `cast` or
    `same`. With `profile`, also `row_count`, `filled` and `rejected` from one
    pass over the data.
    """
    spark = df.sparkSession
    source = spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "name string, source_type string",
    )
    wanted = spark.createDataFrame(
        [(name, dtype.simpleString()) for name, dtype in target.types().items()],
        "name string, target_type string",
    )
    s, t = F.col("source_type"), F.col("target_type")
    whole = [dtype().simpleString() for dtype in (*_WHOLE, T.DoubleType, T.FloatType)]
    status = (
        F.when(s.isNull(), "missing")
        .when(t.isNull(), "extra")
        .when(s == t, "same")
        .when((t == "timestamp_ntz") & (s.isin(whole) | s.startswith("decimal")), "epoch")
        .otherwise("cast")
    )
    report = source.join(wanted, "name", "full_outer").select("name", s, t, status.alias("status"))
    if profile:
        report = report.join(column_profile(df, target), "name", "left")
    return report


def _conformed(
    field: T.StructField, wanted: T.DataType, on_error: str, precision: str, strict_epochs: bool
) -> str:
    value = quote(field.name)
    cast = "CAST" if on_error == "fail" else "TRY_CAST"
    if field.dataType == wanted:
        return value
    given = value
    if on_error == "null" and isinstance(field.dataType, T.StringType):
        # Same result; TRY_CAST raises and catches an exception per bad text.
        given = f"NULLIF({value}, '')"
    if isinstance(wanted, T.TimestampNTZType):
        if isinstance(field.dataType, _WHOLE):
            return epoch_sql(f"CAST({value} AS BIGINT)", precision, strict_epochs)
        if isinstance(field.dataType, _BROKEN):
            number = f"TRY_CAST({value} AS BIGINT)"
            return f"CASE WHEN {number} = {value} THEN {epoch_sql(number, precision, strict_epochs)} END"
        if isinstance(field.dataType, T.StringType):
            epoch = epoch_sql(f"TRY_CAST({value} AS BIGINT)", precision, strict_epochs)
            digits = literal(r"^[ \t\r\n]*[0-9]+[ \t\r\n]*$")
            return (
                f"CASE WHEN {value} RLIKE {digits} THEN {epoch} "
                f"ELSE {cast}({given} AS TIMESTAMP_NTZ) END"
            )
    return f"{cast}({given} AS {wanted.simpleString()})"


def _epoch_options(options: dict) -> dict:
    return {"precision": "seconds", "strict_epochs": True} | options


def _require(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")
