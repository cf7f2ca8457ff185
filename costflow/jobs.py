"""Command line for the load jobs, for use with spark-submit.

    spark-submit costflow_job.py replace  --source s3a://in/cost --ddl s3a://in/cost.sql --table db.cost
    spark-submit costflow_job.py periods  --source s3a://in/cost --months 2025-09,2025-10 ...
    spark-submit costflow_job.py checked  --source s3a://in/cost --ddl s3a://in/cost.sql --table db.cost --drift fill
    spark-submit costflow_job.py split    --source ... --rejects db.cost_rejects ...
    spark-submit costflow_job.py ingest   --source ... --checkpoint s3a://state/cost ...
    spark-submit costflow_job.py files    --source s3a://in/cost --deep
    spark-submit costflow_job.py compact  --table db.cost
"""

from __future__ import annotations

import argparse
from datetime import date

from costflow.plans.chain import load_periods, load_replace, load_replace_sql
from costflow.plans.feed import generate_feed
from costflow.plans.health import file_health, preflight
from costflow.plans.quarantine import load_quarantined
from costflow.plans.report import DRIFT, load_checked
from costflow.session import build_session
from costflow.sinks.files import overwrite_parquet
from costflow.sinks.runlog import RunLog
from costflow.sinks.table import TableSink, create_database
from costflow.sources.text import load_target
from costflow.streaming.incremental import ingest_new_files


def month_period(base: str, month: str) -> tuple[str, date, date]:
    """The folder `<base>/YYYY-MM` with its first date and the first of the next month."""
    first = date.fromisoformat(f"{month}-01")
    past = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return f"{base.rstrip('/')}/{month}", first, past


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="costflow")
    jobs = parser.add_subparsers(dest="job", required=True)

    def load(name: str, summary: str) -> argparse.ArgumentParser:
        job = jobs.add_parser(name, help=summary)
        job.add_argument("--source", required=True, help="folder of Parquet files")
        job.add_argument("--ddl", help="CREATE TABLE text; without it types stay as they are")
        job.add_argument("--table", required=True)
        job.add_argument("--location", help="folder for the table's data")
        job.add_argument("--format", default="parquet", choices=("parquet", "iceberg"))
        job.add_argument("--log", help="folder for markers and summaries")
        job.add_argument("--missing", default="ignore", choices=("ignore", "fill", "fail"))
        job.add_argument("--extra", default="keep", choices=("keep", "drop", "fail"))
        job.add_argument("--on-error", default="fail", choices=("fail", "null"))
        return job

    load("replace", "replace the table").add_argument(
        "--form", default="dataframe", choices=("dataframe", "sql")
    )
    periods = load("periods", "load one folder per month")
    periods.add_argument("--months", required=True, help="YYYY-MM, separated by commas")
    periods.add_argument("--mode", default="replace", choices=("replace", "append"))
    checked = load("checked", "replace the table and tell what happened to each column")
    checked.add_argument("--drift", default="warn", choices=DRIFT)
    checked.add_argument("--max-rejected", type=int, help="values that may not fit before the load is refused")
    load("split", "good rows to the table, rows with values that do not fit to another").add_argument("--rejects", required=True)
    ingest = load("ingest", "load the files that are new since the last run")
    ingest.add_argument("--checkpoint", required=True)
    files = jobs.add_parser("files", help="name damaged files")
    files.add_argument("--source", required=True)
    files.add_argument("--deep", action="store_true", help="read all columns, not only footers")
    compact = jobs.add_parser("compact", help="pack small files")
    compact.add_argument("--table", required=True)
    compact.add_argument("--location", help="folder for the table's data")
    compact.add_argument("--bytes", type=int, default=134217728, help="size of a file")
    check = jobs.add_parser("check", help="check source, DDL and database")
    for name in ("--source", "--ddl", "--database"):
        check.add_argument(name, required=True)
    feed = jobs.add_parser("generate", help="write a synthetic feed")
    feed.add_argument("--output", required=True)
    feed.add_argument("--rows", type=int, default=1_000_000)
    feed.add_argument("--files", type=int, default=16)
    return parser.parse_args(arguments)


def run(spark, options: argparse.Namespace) -> None:
    if options.job == "check":
        preflight(spark, options.source, options.ddl, options.database).show(truncate=False)
        return
    if options.job == "generate":
        feed = generate_feed(spark, options.rows, partitions=options.files)
        overwrite_parquet(feed, options.output, codec="snappy")
        return
    if options.job == "files":
        file_health(spark, options.source, deep=options.deep).where("NOT ok").show(1000, truncate=False)
        return
    if options.job == "compact":
        changed = TableSink(options.table, location=options.location).compact(spark, options.bytes)
        print(f"{changed} partitions packed")
        return
    if "." in options.table:
        create_database(spark, options.table.rpartition(".")[0])
    target = load_target(spark, options.ddl) if options.ddl else None
    sink = TableSink(options.table, location=options.location, fmt=options.format)
    log = RunLog(spark, options.log) if options.log else None
    if options.job in ("checked", "split", "ingest"):
        if target is None:
            raise SystemExit(f"{options.job} needs --ddl")
        if options.job == "checked":
            load_checked(spark, options.source, target, sink, options.drift, options.max_rejected, log).show(1000, truncate=False)
        elif options.job == "split":
            rejects = TableSink(options.rejects, fmt=options.format)
            good, bad = load_quarantined(spark, options.source, target, sink, rejects, missing=options.missing)
            print(f"{good.count()} rows loaded, {bad.count()} set aside")
        else:
            ingest_new_files(spark, options.source, target, sink, options.checkpoint, missing=options.missing, on_error=options.on_error)
        return
    settings = {"log": log}
    if target:
        settings |= {"missing": options.missing, "extra": options.extra, "on_error": options.on_error}
    if options.job == "periods":
        months = [month_period(options.source, m) for m in options.months.split(",")]
        load_periods(spark, months, target, sink, options.mode, **settings)
    else:
        load = load_replace_sql if options.form == "sql" else load_replace
        load(spark, options.source, target, sink, **settings)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = build_session(f"costflow-{options.job}")
    run(spark, options)
    spark.stop()
