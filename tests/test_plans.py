import json
import re
import uuid
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from costflow import inputs
from costflow.inputs import COST_FEED_DDL
from costflow.operators.catalog import TargetSchema, target_from_text
from costflow.operators.names import lowercase_nested
from costflow.plans.chain import load_periods, load_replace, load_replace_sql, standardize
from costflow.plans.feed import generate_feed, wide_ddl
from costflow.plans.health import health_check
from costflow.sinks.runlog import RunLog
from costflow.sinks.table import TableSink
from costflow.sources.files import file_attributes, file_inventory
from costflow.sources.parquet import scan_folder, scan_periods, scan_recursive
from costflow.streaming.incremental import ingest_new_files


@pytest.fixture()
def target(spark):
    return target_from_text(spark, COST_FEED_DDL)


@pytest.fixture()
def feed_path(spark, sf_dir, tmp_path):
    path = str(tmp_path / "feed")
    inputs.cost_feed(spark, sf_dir).write.parquet(path)
    return path


def new_sink(tmp_path, **options):
    return TableSink(f"t_{uuid.uuid4().hex[:10]}", location=str(tmp_path / "tables"), **options)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_transforms_are_one_projection(spark, feed_path, target):
    plan = optimized(standardize(scan_folder(spark, feed_path), target))
    assert plan.count("Project [") == 1
    assert "named_struct" not in plan


def test_transforms_do_not_shuffle(spark, feed_path, target):
    plan = executed(standardize(scan_folder(spark, feed_path), target))
    assert "Exchange" not in plan and "Python" not in plan


def test_only_used_struct_members_are_read(spark, feed_path, target):
    out = standardize(scan_folder(spark, feed_path), target)
    plan = executed(out.select("costcurrencyvendorraw_cost"))
    assert "ReadSchema: struct<CostCurrencyVendorRaw:struct<Cost:double>>" in plan
    nested = lowercase_nested(scan_folder(spark, feed_path)).select("costcurrencyvendorusd.cost")
    assert "ReadSchema: struct<CostCurrencyVendorUSD:struct<Cost:double>>" in executed(nested)


def test_filters_on_flat_columns_reach_the_files(spark, feed_path, target):
    out = standardize(scan_folder(spark, feed_path), target)
    plan = executed(out.where("costcurrencyvendorraw_cost > 5").select("recordid"))
    assert "GreaterThan(CostCurrencyVendorRaw.Cost,5.0)" in plan


def test_partition_filter_prunes_the_table(spark, feed_path, target, tmp_path):
    table = load_replace(spark, feed_path, target, new_sink(tmp_path))
    plan = executed(table.where("partitiondate = DATE'2000-05-01'").select("recordid"))
    assert re.search(r"PartitionFilters: \[.*partitiondate", plan)
    assert "ReadSchema: struct<recordid:bigint>" in plan


def test_write_shuffles_once_and_only_if_asked(spark, feed_path, target, tmp_path):
    prepared = new_sink(tmp_path)._prepared(standardize(scan_folder(spark, feed_path), target))
    assert executed(prepared).count("Exchange hashpartitioning") == 1
    laid_out = new_sink(tmp_path, cluster=False)
    assert "Exchange" not in executed(laid_out._prepared(standardize(scan_folder(spark, feed_path), target)))


def test_both_forms_agree_in_rows_and_column_order(spark, feed_path, target, tmp_path):
    frame = load_replace(spark, feed_path, target, new_sink(tmp_path), layout="in_place")
    sql = load_replace_sql(spark, feed_path, target, new_sink(tmp_path))
    assert frame.schema == sql.schema
    assert frame.columns[-1] == "partitiondate"
    assert Counter(frame.collect()) == Counter(sql.collect())


def test_sql_form_drops_its_views(spark, feed_path, target, tmp_path):
    before = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    load_replace_sql(spark, feed_path, target, new_sink(tmp_path))
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} == before


def test_load_without_target_keeps_types(spark, feed_path, tmp_path):
    for load in (load_replace, load_replace_sql):
        table = load(spark, feed_path, None, new_sink(tmp_path))
        assert table.schema["usagestarttime"].dataType.simpleString() == "bigint"


def test_markers_and_summary(spark, feed_path, target, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"), run_id="run-1")
    sink = new_sink(tmp_path)
    load_replace(spark, feed_path, target, sink, log)
    steps = [(r.step, r.column_count) for r in log.markers().orderBy("seq").collect()]
    assert steps == [("start", None), ("source_opened", 10), ("planned", 14), ("written", 14)]
    summary = log.summaries().first()
    assert summary.raw_count == summary.output_count == spark.table(sink.table).count()
    assert set(summary.timings) == {"read_sec", "standardize_sec", "write_sec", "total_sec"}
    again = RunLog(spark, str(tmp_path / "log"), run_id="run-2")
    again.mark("start")
    assert again.markers().count() == 1
    assert again.markers(all_runs=True).count() == 5
    line = next(iter((tmp_path / "log" / "summaries").glob("part-*.json"))).read_text()
    assert json.loads(line)["job"] == "load_replace"


def month(spark, path, first, ddl_columns, days=3):
    df = generate_feed(spark, 90, date.fromisoformat(first)).where(
        F.col("partitiondate") < F.date_add(F.lit(first).cast("date"), days)
    )
    df.drop(*ddl_columns).write.parquet(path)


def test_periods_with_drifting_columns(spark, tmp_path):
    target = TargetSchema.of([("accountid", "string"), ("status", "string"), ("partitiondate", "date")])
    month(spark, str(tmp_path / "2025-09"), "2025-09-01", ["status"])
    month(spark, str(tmp_path / "2025-10"), "2025-10-01", [])
    periods = [
        (str(tmp_path / "2025-09"), date(2025, 9, 1), date(2025, 10, 1)),
        (str(tmp_path / "2025-10"), date(2025, 10, 1), date(2025, 11, 1)),
    ]
    sink = new_sink(tmp_path)
    for _ in range(2):
        table = load_periods(spark, periods, target, sink, missing="fill")
    counts = table.groupBy(F.month("partitiondate").alias("m"), "status").count().collect()
    assert {tuple(r) for r in counts} == {(9, None, 9), (10, "ok", 9)}
    doubled = load_periods(spark, periods[:1], target, sink, mode="append", missing="fill")
    assert doubled.count() == 27
    with pytest.raises(ValueError, match="mode"):
        load_periods(spark, periods, target, sink, mode="merge")


def test_scans_by_folder_period_and_braces(spark, tmp_path):
    for name in ("2025-09", "2025-10", "2025-11"):
        spark.range(5).write.parquet(str(tmp_path / name / "deep" / "er"))
    (tmp_path / "2025-09" / "notes.txt").write_text("no data")
    assert scan_recursive(spark, str(tmp_path)).count() == 15
    assert scan_periods(spark, str(tmp_path), ["2025-09", "2025-11"]).count() == 10
    assert scan_recursive(spark, f"{tmp_path}/{{2025-09,2025-10}}").count() == 10
    with pytest.raises(ValueError, match="periods"):
        scan_periods(spark, str(tmp_path), [])


def test_inventory_counts_what_is_there(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "a" / "b"))
    upper = tmp_path / "a" / "X.PARQUET"
    upper.write_bytes(b"0" * 1536)
    (tmp_path / "a" / "c.txt").write_text("x")
    files = [*(tmp_path / "a" / "b").glob("*.parquet"), upper]
    total = sum(f.stat().st_size for f in files)
    got = file_inventory(spark, str(tmp_path)).first()
    assert (got.n_files, got.total_bytes) == (len(files), total)
    sizes = sorted(r.length for r in file_attributes(spark, str(tmp_path)).collect())
    assert sizes == sorted(f.stat().st_size for f in files)
    assert file_inventory(spark, str(tmp_path / "a" / "nothing")).first()[1:] == (0, 0, "0.00 B")


def test_inventory_reads_no_content(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "a"))
    assert "content" not in executed(file_attributes(spark, str(tmp_path)))


def test_health_turns_failures_into_rows(spark, tmp_path):
    spark.sql("SELECT IF(id < 3, NULL, id) AS k FROM range(10)").write.parquet(str(tmp_path / "nulls"))
    spark.range(4).write.parquet(str(tmp_path / "good"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    broken = tmp_path / "broken"
    spark.range(4).coalesce(1).write.parquet(str(broken))
    (part,) = broken.glob("*.parquet")
    body = bytearray(part.read_bytes())
    body[4:60] = b"\xff" * 56
    part.write_bytes(bytes(body))
    (broken / f".{part.name}.crc").unlink()
    given = {
        "nulls": (str(tmp_path / "nulls"), "k"),
        "good": (str(tmp_path / "good"), "id"),
        "empty": (str(tmp_path / "empty"), "id"),
        "absent": (str(tmp_path / "absent"), "id"),
        "no_key": (str(tmp_path / "good"), "nope"),
        "broken": (str(broken), "id"),
    }
    rows = {r.input: r for r in health_check(spark, given, isolate=True).collect()}
    assert {n: r.ok for n, r in rows.items()} == {
        "nulls": False, "good": True, "empty": False, "absent": False, "no_key": False, "broken": False
    }
    assert (rows["nulls"].row_count, rows["nulls"].null_keys) == (10, 3)
    assert rows["absent"].problem == "PATH_NOT_FOUND"
    assert rows["broken"].problem
    del given["broken"]
    assert health_check(spark, given).count() == 5


def test_generated_feed(spark):
    feed = generate_feed(spark, 95, partitions=16)
    assert feed.count() == 95
    assert feed.select("partitiondate").distinct().count() == 30
    row = feed.where("record_id = 31").first()
    assert row.accountid == "acct-31"
    assert row.partitiondate == date(2025, 9, 2)
    assert row.costcurrencyvendorraw == (31 * 0.03, 31 * 0.04, "USD")
    assert "Exchange" not in executed(feed)


def test_wide_table_round_trip(spark, tmp_path):
    target = target_from_text(spark, wide_ddl())
    ids = F.col("id")
    columns = [
        F.lit(1756684800123).alias(c.name) if c.spark_type == "timestamp_ntz"
        else (ids % 2).alias(c.name) if c.spark_type == "boolean"
        else F.lit(date(2025, 9, 1)).alias(c.name) if c.spark_type == "date"
        else ids.alias(c.name)
        for c in target.columns
    ]
    spark.range(20).select(*columns).write.parquet(str(tmp_path / "wide"))
    table = load_replace(spark, str(tmp_path / "wide"), target, new_sink(tmp_path))
    assert len(table.columns) == 507 and table.count() == 20
    assert {f.name: f.dataType for f in table.schema.fields} == target.types()


def test_stream_takes_each_file_once(spark, tmp_path):
    target = TargetSchema.of([("record_id", "string"), ("partitiondate", "date")])
    args = (str(tmp_path / "in"), target, new_sink(tmp_path), str(tmp_path / "check"))
    for n in range(3):
        feed = generate_feed(spark, 40).withColumn("record_id", F.col("record_id") + 40 * n)
        feed.write.parquet(str(tmp_path / "in" / f"lot{n}"))
        taken = ingest_new_files(spark, *args)
        assert taken.count() == taken.select("record_id").distinct().count() == 40 * (n + 1)
    assert ingest_new_files(spark, *args, max_files_per_batch=1).count() == 120
