"""The full load: scan, lower-case, flatten, conform, write."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager, nullcontext
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costflow.operators.catalog import TargetSchema
from costflow.operators.conform import conform, conform_items
from costflow.operators.flatten import (
    COST_STRUCTS,
    flatten_append,
    flatten_in_place,
    flatten_in_place_items,
)
from costflow.operators.layout import partition_last_items
from costflow.operators.names import lowercase_nested_items, lowercase_top_items
from costflow.sinks.runlog import RunLog
from costflow.sinks.table import TableSink
from costflow.sources.parquet import scan_recursive
from costflow.sqltext import project, quote, select_statement

LAYOUTS = {"append": flatten_append, "in_place": flatten_in_place}


def standardize(
    df: DataFrame, target: TargetSchema | None, layout: str = "append", **policies
) -> DataFrame:
    """Raw feed to flat, typed columns. Lazy; Catalyst folds it into one projection.

    The cost structs are not rebuilt with lower-case members only to be taken
    apart again: members come straight from the file's struct, so the scan reads
    just those a consumer asks for and filters on them reach it.
    Without a target the cast step is left out. `policies` go to `conform`.
    """
    flat = flattened(df, layout)
    return flat if target is None else conform(flat, target, **policies)


def flattened(df: DataFrame, layout: str = "append") -> DataFrame:
    """`standardize` without its cast step: lower-case names and flat cost structs."""
    lower = project(df, lowercase_nested_items(df.schema, shallow=COST_STRUCTS))
    return LAYOUTS[layout](lower, deep=True)


def load_replace(
    spark: SparkSession,
    source: str | DataFrame,
    target: TargetSchema | None,
    sink: TableSink,
    log: RunLog | None = None,
    **policies,
) -> DataFrame:
    """Replace the table by the standardized source; returns the table read back.

    One pass over the source. Counts come from the footers of what was read and
    written; a DataFrame as source would have to run again, so it is not counted.
    """
    with _logged(log) as (mark, timed):
        with timed("read"):
            raw = opened(spark, source)
        mark("source_opened", column_count=len(raw.columns))
        with timed("standardize"):
            out = standardize(raw, target, **policies)
        mark("planned", column_count=len(out.columns))
        with timed("write"):
            sink.replace(out)
        return _finished("load_replace", source, raw, sink, log)


def load_replace_sql(
    spark: SparkSession,
    source: str | DataFrame,
    target: TargetSchema | None,
    sink: TableSink,
    log: RunLog | None = None,
    **policies,
) -> DataFrame:
    """`load_replace` over temp views and one CREATE TABLE AS SELECT.

    Each stage is a view on the one before. The select lists are those of the
    DataFrame operators with flattening in place, so both forms agree in values.
    """
    prefix = f"load_{uuid.uuid4().hex[:12]}"
    views = [f"{prefix}_raw"]
    stages = {
        "lower": lowercase_top_items,
        "flat": flatten_in_place_items,
        "typed": lambda schema: conform_items(schema, target, **policies),
        "final": lambda schema: partition_last_items(schema, sink.partition_col),
    }
    if target is None:
        del stages["typed"]
    with _logged(log) as (mark, timed):
        try:
            with timed("read"):
                raw = opened(spark, source)
                raw.createOrReplaceTempView(views[0])
            mark("source_opened", column_count=len(raw.columns))
            with timed("standardize"):
                for stage, items_of in stages.items():
                    items = items_of(spark.table(views[-1]).schema)
                    query = select_statement(items, quote(views[-1]))
                    views.append(f"{prefix}_{stage}")
                    spark.sql(f"CREATE OR REPLACE TEMP VIEW {views[-1]} AS {query}")
            mark("planned", column_count=len(spark.table(views[-1]).columns))
            with timed("write"):
                sink.replace_from_view(spark, views[-1])
        finally:
            for name in views:
                spark.catalog.dropTempView(name)
        return _finished("load_replace_sql", source, raw, sink, log)


def load_periods(
    spark: SparkSession,
    periods: Iterable[tuple[str, date, date]],
    target: TargetSchema | None,
    sink: TableSink,
    mode: str = "replace",
    log: RunLog | None = None,
    **policies,
) -> DataFrame:
    """Load `(path, first date, date past the last)` periods in one job: one scan, one write.

    The path of its file tells the period of a row, whose date must lie in it.
    `mode="replace"` may be repeated safely, `mode="append"` adds rows each time.
    Columns that some periods lack become nulls there. With a log, the rows of each
    period are counted in the same pass.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")
    periods = list(periods)
    if not periods:
        raise ValueError("no periods given")
    if not _apart(periods):
        for period in periods:
            table = load_periods(spark, [period], target, sink, mode, log, **policies)
        return table
    with _logged(log) as (mark, timed):
        with timed("periods"):
            out = standardize(scan_recursive(spark, *(path for path, _, _ in periods)), target, **policies)
            dated = sink.partition_of(out)
            rows = Observation()
            if dated:
                day = F.col(quote(dated)).cast("date")
                number = _period_of(day, periods)
                if mode == "replace":
                    out = out.withColumn(dated, _at_home(day, number, periods))
                counts = [F.count_if(number == n).alias(f"rows_{n}") for n in range(len(periods))]
                out = out.observe(rows, *counts) if log else out
            if mode == "replace":
                sink.replace_periods(out, [(first, past) for _, first, past in periods])
            else:
                sink.create_or_append(out)
        if log:
            found = rows.get if dated else {}
            for n, (path, first, _) in enumerate(periods):
                mark(f"period_{first}", path, found.get(f"rows_{n}"), len(out.columns))
            written = spark.table(sink.table).count()  # from footers
            log.summarize("load_periods", sink.table, ",".join(p for p, _, _ in periods), sum(found.values()) if found else None, written, len(out.columns))
    return spark.table(sink.table)


def _apart(periods: Sequence[tuple[str, date, date]]) -> bool:
    """Whether the periods share no date and their paths are plain, so that a row's date tells its path."""
    dates = sorted((first, past) for _, first, past in periods)
    plain = len(periods) == 1 or not any(set("*?{[") & set(path) for path, _, _ in periods)
    return plain and all(past <= first for (_, past), (first, _) in zip(dates, dates[1:]))


def _period_of(day: Column, periods: Sequence[tuple[str, date, date]]) -> Column:
    """The number of the period that holds the date, or null."""
    return F.coalesce(*(F.when((day >= F.lit(first)) & (day < F.lit(past)), F.lit(n)) for n, (_, first, past) in enumerate(periods)))


def _at_home(day: Column, number: Column, periods: Sequence[tuple[str, date, date]]) -> Column:
    """The date; a row whose file does not lie below the path of its date's period fails the job."""
    good = number.isNotNull()
    if len(periods) > 1:
        # Paths may be written with or without a scheme; what follows it is compared.
        place = F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z0-9]+:/*", "/")
        folders = F.array(*(F.lit(f"/{path.split(':', 1)[-1].strip('/')}/") for path, _, _ in periods))
        good = good & F.contains(place, F.element_at(folders, number + 1))
    message = F.format_string("partition date %s is outside the period of its file %s", day.cast("string"), F.col("_metadata.file_path"))
    return F.when(good, day).otherwise(F.raise_error(message).cast("date"))


def opened(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    return scan_recursive(spark, source) if isinstance(source, str) else source


@contextmanager
def _logged(log: RunLog | None):
    """(mark, timed) of a log, or stand-ins; an exception leaves a marker too."""
    if log is None:
        yield (lambda *_, **__: None), (lambda _: nullcontext())
        return
    log.mark("start")
    try:
        yield log.mark, log.timed
    except Exception as error:
        log.mark("failed", f"{type(error).__name__}: {error}")
        raise


def _finished(
    job: str, source: str | DataFrame, raw: DataFrame, sink: TableSink, log: RunLog | None
) -> DataFrame:
    table = raw.sparkSession.table(sink.table)
    if log:
        written, width = table.count(), len(table.columns)
        log.mark("written", sink.table, written, width)
        origin, rows = (source, raw.count()) if isinstance(source, str) else ("DataFrame", None)
        log.summarize(job, sink.table, origin, rows, written, width)
    return table
