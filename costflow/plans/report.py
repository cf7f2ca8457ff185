"""A load that tells what it did to each column, from counts taken in the pass that writes."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costflow.operators.catalog import TargetSchema
from costflow.operators.conform import column_profile, conform, schema_report
from costflow.plans.chain import flattened, opened
from costflow.sinks.runlog import RunLog
from costflow.sinks.table import TableSink
from costflow.sqltext import quote

LOG = logging.getLogger("costflow")

#: What to do about columns that data and target do not share, and about unknown target types.
DRIFT = ("fail", "warn", "fill")

REPORT_COUNTS = "name string, filled bigint, rejected bigint"


class Rejected(ValueError):
    """More values than allowed do not fit their target types."""


class Watch:
    """Counts of a load's columns, before and after the cast, taken while its rows pass.

    `rows` is the typed DataFrame to write, once. `report` may be read after that.
    """

    def __init__(self, flat: DataFrame, target: TargetSchema, **policies):
        self.flat, self.target = flat, target
        self._before, self._after = Observation(), Observation()
        types = target.types()
        self._changed = [f.name for f in flat.schema.fields if f.name in types and f.dataType != types[f.name]]
        seen = flat.observe(self._before, F.count(F.lit(1)).alias("rows"), *self._counts(flat.columns))
        typed = conform(seen, target, **policies)
        self.rows = typed.observe(self._after, F.count(F.lit(1)).alias("rows"), *self._counts(self._changed))

    @staticmethod
    def _counts(columns: list[str]) -> list[Column]:
        return [F.count(F.col(quote(c))).alias(f"n_{i}") for i, c in enumerate(columns)]

    def counts(self) -> tuple[int, dict[str, int], dict[str, int]]:
        """Rows, and per column the values that are there and those that do not fit."""
        before, after = self._before.get, self._after.get
        filled = {c: before[f"n_{i}"] for i, c in enumerate(self.flat.columns)}
        fitting = {c: after[f"n_{i}"] for i, c in enumerate(self._changed)}
        return before["rows"], filled, {c: n - fitting.get(c, n) for c, n in filled.items()}

    def report(self, written: int | None = None) -> DataFrame:
        """(name, source_type, target_type, status, recognized, row_count, filled, rejected), one row per column of either side.

        Observed numbers count rows again that a lost executor made Spark repeat.
        Where the number of rows differs from `written`, which comes from the
        footers, the columns are counted in a pass of their own.
        """
        spark = self.flat.sparkSession
        rows, filled, rejected = self.counts()
        if written is not None and rows != written:
            LOG.warning("%s rows were observed and %s written; counting once more", rows, written)
            counts = column_profile(self.flat, self.target)
        else:
            found = [(c, filled[c], rejected[c]) for c in self.flat.columns]
            counts = spark.createDataFrame(found, REPORT_COUNTS).select("name", F.lit(rows).cast("long").alias("row_count"), "filled", "rejected")
        unknown = [c.name.lower() for c in self.target.unrecognized()]
        known = F.when(F.col("target_type").isNotNull(), ~F.col("name").isin(unknown) if unknown else F.lit(True))
        report = schema_report(self.flat, self.target).withColumn("recognized", known)
        return report.join(counts, "name", "left")


def drift(flat: DataFrame, target: TargetSchema) -> list[str]:
    """One line for each column that only one side has, and for each target type that is not known."""
    types = target.types()
    lines = [f"{c} is not in the target" for c in flat.columns if c not in types]
    lines += [f"{c} is not in the data" for c in types if c not in flat.columns]
    return lines + [f"{c.name.lower()} has the unknown type {c.type_text!r}, read as {c.spark_type}" for c in target.unrecognized()]


def load_checked(
    spark: SparkSession,
    source: str | DataFrame,
    target: TargetSchema,
    sink: TableSink,
    on_drift: str = "warn",
    max_rejected: int | None = None,
    log: RunLog | None = None,
    layout: str = "append",
    **policies,
) -> DataFrame:
    """`load_replace` with a gate and a report; one pass over the source. Returns the report of `Watch`.

    `on_drift`: columns that one side lacks, and types that are not known, fail
    the load before it starts, are written to the log, or are written to the log
    and missing columns filled with nulls. `max_rejected`: if more values than
    that do not fit, the new table does not take its place and `Rejected` is
    raised. Bad values become nulls and are counted.
    """
    if on_drift not in DRIFT:
        raise ValueError(f"on_drift must be one of {DRIFT}, not {on_drift!r}")
    flat = flattened(opened(spark, source), layout)
    lines = drift(flat, target)
    if lines and on_drift == "fail":
        raise ValueError(f"data and target differ: {lines}")
    for line in lines:
        LOG.warning(line)
    policies = {"on_error": "null", "missing": "fill" if on_drift == "fill" else "ignore"} | policies
    watch = Watch(flat, target, **policies)
    reports: list[DataFrame] = []

    def accept(table: DataFrame) -> None:
        written = table.count()  # from footers
        report = watch.report(written)
        reports.append(report)
        bad = {row["name"]: row["rejected"] for row in report.where("rejected > 0").collect()}
        if log:
            log.mark("written", "; ".join([*lines, *(f"{c}: {n} rejected" for c, n in sorted(bad.items()))]), written, len(table.columns))
        if max_rejected is not None and sum(bad.values()) > max_rejected:
            raise Rejected(f"values that do not fit: {bad}")

    sink.replace(watch.rows, accept)
    return reports[0]
