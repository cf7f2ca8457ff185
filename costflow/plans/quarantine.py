"""A load that sets rows aside whose values do not fit, in the pass that writes the others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.operators.catalog import TargetSchema
from costflow.operators.conform import conform
from costflow.operators.distribute import distribute_sorted
from costflow.plans.chain import flattened, opened
from costflow.sinks.table import TableSink
from costflow.sources.files import path_exists
from costflow.sqltext import literal, quote

#: Columns of a row set aside: its values as JSON before any cast, and why it is here.
RAW, REASONS = "raw", "reasons"
#: The folder level that keeps both kinds apart.
ASIDE = "rejected"


def judged(flat: DataFrame, target: TargetSchema, **policies) -> DataFrame:
    """`conform` without failures, plus `raw`, `reasons` and `rejected` for each row.

    A row is rejected if one of its values is there and does not fit its target
    type; epochs outside of the calendar guard are such values. `reasons` has one
    line for each, `raw` the row's values before the cast as JSON. Both are null
    in good rows.
    """
    types = target.types()
    kept = F.struct(*(F.col(quote(c)) for c in flat.columns)).alias("_given")
    typed = conform(flat.select("*", kept), target, **{**policies, "on_error": "null", "extra": "keep"})
    changed = [f for f in flat.schema.fields if f.name in types and f.dataType != types[f.name]]
    given = lambda c: F.col(f"_given.{quote(c)}")
    lines = [
        F.when(
            given(f.name).isNotNull() & F.col(quote(f.name)).isNull(),
            F.lit(f"{f.name}: {f.dataType.simpleString()} does not fit {types[f.name].simpleString()}"),
        )
        for f in changed
    ]
    reasons = F.array_compact(F.array(*lines)) if lines else F.array().cast("array<string>")
    bad = F.size("_reasons") > 0
    typed = typed.withColumn("_reasons", reasons)
    if policies.get("extra") == "drop":
        typed = typed.drop(*(c for c in flat.columns if c not in types))
    return typed.withColumns(
        {RAW: F.when(bad, F.to_json("_given")), REASONS: F.when(bad, F.col("_reasons")), ASIDE: bad}
    ).drop("_given", "_reasons")


def load_quarantined(
    spark: SparkSession,
    source: str | DataFrame,
    target: TargetSchema,
    sink: TableSink,
    rejects: TableSink,
    layout: str = "append",
    **policies,
) -> tuple[DataFrame, DataFrame]:
    """Good rows to one table, rejected ones to another; one pass over the source, one write.

    Both kinds go to one fresh folder of `sink`, a level each. When all is
    written, a table is laid over each level and takes its place. Every row of the
    source is in exactly one of the two. Returns both tables.
    """
    flat = flattened(opened(spark, source), layout)
    clashes = sorted({RAW, REASONS, ASIDE} & set(flat.columns))
    if clashes:
        raise ValueError(f"columns of the data are named like those of the quarantine: {clashes}")
    rows = judged(flat, target, **policies)
    date = sink.partition_of(rows)
    if date:
        rows = rows.withColumn(date, F.col(quote(date)).cast("date"))
    keys = [ASIDE, *([date] if date else [])]
    folder = sink.fresh_folder(spark)
    distribute_sorted(rows, *keys).write.options(**sink.write_options()).partitionBy(*keys).parquet(folder)
    good = [f for f in rows.schema.fields if f.name not in (RAW, REASONS, ASIDE)]
    bad = [f for f in rows.schema.fields if f.name in (RAW, REASONS, date)]
    for own, fields, level in ((sink, good, "false"), (rejects, bad, "true")):
        columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in [*(f for f in fields if f.name != date), *(f for f in fields if f.name == date)])
        staged, place = own.staged_name(), f"{folder}/{ASIDE}={level}"
        by = f"PARTITIONED BY ({quote(date)})" if date else ""
        spark.sql(f"CREATE TABLE {staged} ({columns}) USING parquet {by} LOCATION {literal(place)}")
        if date and path_exists(spark, place):
            spark.sql(f"ALTER TABLE {staged} RECOVER PARTITIONS")
        own.publish(spark, staged)
    return spark.table(sink.table), spark.table(rejects.table)
