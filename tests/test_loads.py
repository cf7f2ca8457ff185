"""Loads that are cut off, checked, quarantined, resumed, compacted or read while they are replaced."""

import logging
import threading
import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costflow.inputs import cut_off_copy
from costflow.operators.catalog import TargetColumn, TargetSchema
from costflow.operators.layout import cluster_by_all, column_bounds
from costflow.operators.widen import TypeConflict, merged, widened_items, widest
from costflow.plans.chain import load_periods
from costflow.plans.health import file_health
from costflow.plans.quarantine import judged, load_quarantined
from costflow.plans.report import Rejected, drift, load_checked
from costflow.plans.restart import run_stages, source_fingerprint
from costflow.sinks.runlog import RunLog
from costflow.sinks.table import BATCH, TableSink
from costflow.sources.files import file_attributes
from costflow.sources.footers import file_footers
from costflow.sources.parquet import scan_recursive, scan_widened
from costflow.sqltext import project
from costflow.streaming.incremental import ingest_new_files


def new_sink(tmp_path, **options):
    name = f"t_{uuid.uuid4().hex[:10]}"
    return TableSink(name, location=str(tmp_path / name), **options)


def days(spark, first, n, per_day=2, tag="a"):
    return spark.sql(
        f"SELECT id AS k, '{tag}' AS tag, date_add(DATE'{first}', CAST(id div {per_day} AS INT)) AS partitiondate "
        f"FROM range({n * per_day})"
    )


def tags(spark, sink):
    return {r.tag: r["count"] for r in spark.table(sink.table).groupBy("tag").count().collect()}


# -- batches -------------------------------------------------------------------


@pytest.mark.parametrize("versioned", [False, True])
def test_a_batch_replaces_its_own_rows_only(spark, tmp_path, versioned):
    sink = new_sink(tmp_path, versioned=versioned)
    sink.replace_batch(days(spark, "2025-09-01", 3), "s-1")
    sink.replace_batch(days(spark, "2025-09-02", 3, tag="b"), "s-2")
    for _ in range(2):
        sink.replace_batch(days(spark, "2025-09-01", 2, tag="c"), "s-1")
    assert tags(spark, sink) == {"b": 6, "c": 4}
    listed = {(r[0], str(r[1])) for r in sink.batches(spark).collect()}
    assert listed == {("s-1", "2025-09-01"), ("s-1", "2025-09-02"), ("s-2", "2025-09-02"), ("s-2", "2025-09-03"), ("s-2", "2025-09-04")}


def test_batches_bring_columns_and_refuse_other_types(spark, tmp_path):
    sink = new_sink(tmp_path)
    sink.replace_batch(days(spark, "2025-09-01", 1), "a")
    sink.replace_batch(days(spark, "2025-09-01", 1).drop("tag").withColumn("more", F.lit(1.5)), "b")
    got = {(r[BATCH], r.tag, r.more) for r in spark.table(sink.table).collect()}
    assert got == {("a", "a", None), ("b", None, 1.5)}
    with pytest.raises(ValueError, match="more: string is not double"):
        sink.replace_batch(days(spark, "2025-09-01", 1).withColumn("more", F.lit("x")), "c")
    assert spark.table(sink.table).count() == 4


def test_columns_without_a_type_are_left_out(spark, tmp_path):
    sink = new_sink(tmp_path)
    for batch, value in (("a", "NULL"), ("b", "'x'"), ("c", "NULL")):
        sink.replace_batch(spark.sql(f"SELECT 1 AS k, {value} AS v, DATE'2025-09-01' AS partitiondate"), batch)
    assert {r[BATCH]: r.v for r in spark.table(sink.table).collect()} == {"a": None, "b": "x", "c": None}


def test_batches_without_a_date(spark, tmp_path):
    sink = new_sink(tmp_path)
    for batch in ("a", "b", "a"):
        sink.replace_batch(spark.range(3), batch)
    assert spark.table(sink.table).count() == 6


def test_a_stream_meets_files_of_other_types_and_streams_do_not_mix(spark, tmp_path):
    target = TargetSchema.of([("k", "bigint"), ("partitiondate", "date")])
    sink, source = new_sink(tmp_path), tmp_path / "in"
    days(spark, "2025-09-01", 2).selectExpr("CAST(k AS INT) AS K", "tag", "partitiondate").write.parquet(str(source / "a"))
    days(spark, "2025-09-02", 2).selectExpr("CAST(k AS STRING) AS k", "partitiondate").write.parquet(str(source / "b" / "deep"))
    for checkpoint in ("one", "two"):
        ingest_new_files(spark, str(source), target, sink, str(tmp_path / checkpoint))
    table = spark.table(sink.table)
    assert table.count() == 16 and table.select(BATCH).distinct().count() == 2
    assert ingest_new_files(spark, str(source), target, sink, str(tmp_path / "one")).count() == 16
    assert table.schema["k"].dataType == T.LongType()


# -- periods -------------------------------------------------------------------


def periods_of(tmp_path):
    return [(str(tmp_path / m), date(2025, int(m), 1), date(2025, int(m) + 1, 1)) for m in ("09", "10")]


def test_periods_are_one_scan_with_counts(spark, tmp_path):
    for m, n in (("09", 3), ("10", 2)):
        days(spark, f"2025-{m}-05", n).write.parquet(str(tmp_path / m))
    log = RunLog(spark, str(tmp_path / "log"))
    for n in range(2):
        table = load_periods(spark, periods_of(tmp_path), None, new_sink(tmp_path / str(n)), log=log if n else None)
        assert table.count() == 10
    counts = {r.step: r.row_count for r in log.markers().collect() if r.step.startswith("period")}
    assert counts == {"period_2025-09-01": 6, "period_2025-10-01": 4}


def test_a_file_in_the_wrong_folder_fails(spark, tmp_path):
    days(spark, "2025-09-05", 2).write.parquet(str(tmp_path / "09"))
    days(spark, "2025-09-08", 2).write.parquet(str(tmp_path / "10"))
    with pytest.raises(PySparkException, match="outside the period of its file"):
        load_periods(spark, periods_of(tmp_path), None, new_sink(tmp_path))


def test_periods_that_overlap_come_one_after_the_other(spark, tmp_path):
    days(spark, "2025-09-01", 2).write.parquet(str(tmp_path / "a"))
    days(spark, "2025-09-02", 2, tag="b").write.parquet(str(tmp_path / "b"))
    both = [(str(tmp_path / "a"), date(2025, 9, 1), date(2025, 9, 3)), (str(tmp_path / "b"), date(2025, 9, 2), date(2025, 9, 4))]
    sink = new_sink(tmp_path)
    load_periods(spark, both, None, sink)
    assert tags(spark, sink) == {"a": 2, "b": 4}


# -- reports -------------------------------------------------------------------

TARGET = TargetSchema.of([("k", "int"), ("n", "decimal(3,1)"), ("partitiondate", "date"), ("absent", "double")])


def counted(spark, df):
    """`df`, and a count of the rows that were read from it."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(look, df.schema), seen


def feed(spark):
    return spark.sql(
        "SELECT CAST(id AS STRING) AS K, IF(id % 5 = 0, 'x', '1.5') AS n, DATE'2025-09-01' AS partitiondate, id AS other FROM range(20)"
    )


def test_a_checked_load_reads_its_source_once(spark, tmp_path):
    source, seen = counted(spark, feed(spark))
    sink = new_sink(tmp_path)
    report = {r.name: r for r in load_checked(spark, source, TARGET, sink, on_drift="fill").collect()}
    assert seen.value == 20
    assert (report["n"].filled, report["n"].rejected, report["n"].row_count) == (20, 4, 20)
    assert (report["absent"].status, report["absent"].filled, report["other"].status) == ("missing", None, "extra")
    assert spark.table(sink.table).where("absent IS NULL").count() == 20


def test_drift_fails_or_warns(spark, tmp_path, caplog):
    sink = new_sink(tmp_path)
    with pytest.raises(ValueError, match="other is not in the target.*absent is not in the data"):
        load_checked(spark, feed(spark), TARGET, sink, on_drift="fail")
    with caplog.at_level(logging.WARNING, "costflow"):
        load_checked(spark, feed(spark), TARGET, sink)
    assert "absent is not in the data" in caplog.text and "absent" not in spark.table(sink.table).columns
    odd = TargetSchema((TargetColumn("K", "GEOGRAPHY", "string", False),))
    assert any("unknown type 'GEOGRAPHY'" in line for line in drift(feed(spark).withColumnRenamed("K", "k"), odd))
    with pytest.raises(ValueError, match="on_drift"):
        load_checked(spark, feed(spark), TARGET, sink, on_drift="hope")


def test_too_many_rejects_keep_the_old_table(spark, tmp_path):
    sink = new_sink(tmp_path)
    load_checked(spark, feed(spark).where("n <> 'x'"), TARGET, sink, max_rejected=0)
    with pytest.raises(Rejected, match="'n': 4"):
        load_checked(spark, feed(spark), TARGET, sink, max_rejected=3)
    assert spark.table(sink.table).count() == 16
    load_checked(spark, feed(spark), TARGET, sink, max_rejected=4, log=RunLog(spark, str(tmp_path / "log")))
    assert spark.table(sink.table).count() == 20


# -- quarantine ----------------------------------------------------------------


def test_each_row_is_in_one_of_two_tables(spark, tmp_path):
    source, seen = counted(spark, feed(spark).withColumn("stamp", F.when(F.col("other") % 7 == 0, 5).otherwise(1756684800)))
    target = TargetSchema.of([("k", "int"), ("n", "decimal(3,1)"), ("stamp", "timestamp_ntz"), ("partitiondate", "date")])
    good, bad = load_quarantined(spark, source, target, new_sink(tmp_path), new_sink(tmp_path))
    assert seen.value == 20 and good.count() + bad.count() == 20
    assert good.columns == ["k", "n", "other", "stamp", "partitiondate"]
    reasons = {r.reasons[0].split(":")[0] + str(len(r.reasons)) for r in bad.collect()}
    assert reasons == {"n1", "n2", "stamp1"} and bad.where("raw LIKE '%\"n\":\"x\"%'").count() == 4


def test_quarantine_without_bad_rows_and_again(spark, tmp_path):
    target = TargetSchema.of([("n", "string"), ("partitiondate", "date")])
    good, bad = new_sink(tmp_path), new_sink(tmp_path)
    for _ in range(2):
        a, b = load_quarantined(spark, feed(spark), target, good, bad)
        assert (a.count(), b.count()) == (20, 0)
    a, b = load_quarantined(spark, feed(spark).drop("partitiondate"), TARGET, good, bad, extra="drop")
    assert (a.count(), b.count(), a.columns) == (16, 4, ["k", "n"])
    with pytest.raises(ValueError, match="reasons"):
        load_quarantined(spark, feed(spark).withColumn("reasons", F.lit(1)), target, good, bad)


def test_purge_leaves_the_quarantine_alone(spark, tmp_path):
    good, bad = new_sink(tmp_path), new_sink(tmp_path)
    for _ in range(2):
        load_quarantined(spark, feed(spark), TARGET, good, bad)
    assert good.purge(spark, keep=0) == 0
    good.replace(days(spark, "2025-09-01", 1))
    good.replace(days(spark, "2025-09-01", 1))
    assert good.purge(spark, keep=0) == 1
    assert spark.table(bad.table).count() == 4 and spark.table(good.table).count() == 2


def test_rows_whose_date_is_bad_are_set_aside(spark, tmp_path):
    source = spark.sql("SELECT id AS k, IF(id = 3, 'soon', '2025-09-01') AS partitiondate FROM range(5)")
    target = TargetSchema.of([("k", "bigint"), ("partitiondate", "date")])
    good, bad = load_quarantined(spark, source, target, new_sink(tmp_path), new_sink(tmp_path))
    assert good.count() == 4 and [r.raw for r in bad.collect()] == ['{"k":3,"partitiondate":"soon"}']
    assert judged(source, TargetSchema.of([("k", "bigint")])).where("rejected").count() == 0


# -- files that disagree -------------------------------------------------------


def kind(name):
    return T.DataType.fromDDL(name)


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("int", "double", "double"), ("float", "double", "double"),
        ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,6)", "decimal(14,6)"), ("decimal(38,0)", "decimal(38,10)", "string"),
        ("decimal(5,2)", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", "timestamp"),
        ("string", "int", "string"), ("boolean", "string", "string"), ("void", "int", "int"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,string>", "map<string,string>"), ("struct<a:int>", "struct<A:bigint,b:string>", "struct<a:bigint,b:string>"),
    ],
)
def test_widest_types(a, b, both):
    assert widest(kind(a), kind(b)).simpleString() == widest(kind(b), kind(a)).simpleString().replace("A:", "a:") == both


@pytest.mark.parametrize(("a", "b"), [("boolean", "int"), ("date", "int"), ("binary", "string"), ("struct<a:int>", "int"), ("timestamp", "timestamp_ntz"), ("array<int>", "string")])
def test_types_without_a_common_one_are_named(a, b):
    schema = lambda x: T.StructType([T.StructField("Part", T.StructType([T.StructField("x", kind(x))]))])
    with pytest.raises(TypeConflict, match=r"Part\.x"):
        merged([schema(a), schema(b)])


def test_nested_columns_are_cast_whole(spark):
    given = spark.sql("SELECT named_struct('A', 1, 'l', array(named_struct('x', 2))) AS s, map('k', 3) AS m, CAST(NULL AS STRUCT<A:INT>) AS n")
    wide = kind("struct<s:struct<A:bigint,l:array<struct<x:string,y:int>>,more:date>,m:map<string,double>,n:struct<A:string>,new:int>")
    cast = project(given, widened_items(given.schema, wide))
    row = cast.first()
    assert cast.schema.simpleString() == wide.simpleString()
    assert (row.s.A, row.s.l[0].x, row.s.l[0].y, row.m, row.n, row.new) == (1, "2", None, {"k": 3.0}, None, None)


def test_scan_of_files_that_disagree(spark, tmp_path):
    for n, sql in enumerate(["1 AS v, 'x' AS only", "2.5D AS V", "'three' AS v", "CAST(4 AS BIGINT) AS v, named_struct('a', 1) AS s", "CAST(NULL AS STRING) AS v, named_struct('a', 'b', 'c', 2) AS s"]):
        spark.sql(f"SELECT {sql}").write.parquet(str(tmp_path / "in" / f"day={n}"))
    got = scan_widened(spark, str(tmp_path / "in"))
    assert got.columns == ["v", "only", "s"] and sorted(str(r.v) for r in got.collect()) == ["1", "2.5", "4", "None", "three"]
    assert {(r.s.a, r.s.c) for r in got.collect() if r.s} == {("1", None), ("b", 2)}
    cut_off_copy(spark, file_attributes(spark, str(tmp_path / "in" / "day=0")).first().path, str(tmp_path / "in" / "cut.parquet"))
    with pytest.raises(ValueError, match="cut.parquet"):
        scan_widened(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="no files"):
        scan_widened(spark, str(tmp_path / "nowhere"))
    assert file_footers(spark, str(tmp_path / "nowhere")).collect() == []


# -- health --------------------------------------------------------------------


def test_damage_in_the_middle_is_found(spark, tmp_path, setting):
    path = tmp_path / "in"
    spark.range(200_000).selectExpr("id", "uuid() AS u").repartition(2).write.option("parquet.block.size", 1 << 20).parquet(str(path))
    bad = sorted(path.glob("part-*"))[0]
    raw = bytearray(bad.read_bytes())
    raw[len(raw) // 2 : len(raw) // 2 + 4000] = b"\xff" * 4000
    bad.write_bytes(raw)
    for crc in path.glob(".*.crc"):
        crc.unlink()
    assert all(r.ok and r.rows_read is None for r in file_health(spark, str(path)).collect())
    found = {r.path.rsplit("/", 1)[-1]: r for r in file_health(spark, str(path), deep=True).collect()}
    assert [name for name, r in found.items() if not r.ok] == [bad.name]
    assert "rows can be read" in found[bad.name].problem and sum(r.n_rows for r in found.values()) == 200_000


# -- stages --------------------------------------------------------------------


def test_a_second_run_goes_on_where_the_first_died(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")
    spark.range(10).write.parquet(source)
    calls = []

    def stage(name, fails=False):
        def run(df):
            calls.append(name)
            if fails and calls.count(name) == 1:
                raise RuntimeError(name)
            return df.withColumn(name, F.lit(1))

        return name, run

    def read(path):
        calls.append("read")
        return scan_recursive(spark, path)

    stages = [stage("standardize"), stage("conform", fails=True), stage("sort")]
    with pytest.raises(RuntimeError):
        run_stages(spark, source, read, stages, folder)
    log = RunLog(spark, str(tmp_path / "log"))
    done = run_stages(spark, source, read, stages, folder, log=log)
    assert calls == ["read", "standardize", "conform", "conform", "sort"] and done.columns == ["id", "standardize", "conform", "sort"]
    assert [r.step for r in log.markers().orderBy("seq").collect()] == ["resumed", "conform", "sort"]
    assert run_stages(spark, source, read, stages, folder).count() == 10 and len(calls) == 5
    run_stages(spark, source, read, stages, folder, settings="other DDL")
    assert calls[5:] == ["read", "standardize", "conform", "sort"]
    before = source_fingerprint(spark, source)
    spark.range(5).write.mode("append").parquet(source)
    assert source_fingerprint(spark, source) != before
    assert run_stages(spark, source, read, stages, folder).count() == 15


# -- versions, compaction, layout ----------------------------------------------


def test_readers_never_miss_a_versioned_table(spark, tmp_path):
    sink = new_sink(tmp_path, versioned=True)
    sink.replace(days(spark, "2025-09-01", 2))
    failures, counts, stop = [], set(), threading.Event()

    def look():
        while not stop.is_set():
            try:
                counts.add(spark.table(sink.table).count())
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=look)
    reader.start()
    for n in range(20):
        sink.replace(days(spark, "2025-09-01", 2 + n % 3))
    stop.set()
    reader.join()
    assert failures == [] and counts <= {4, 6, 8}
    assert sink.purge(spark, keep=2) == 18 and len(list((tmp_path / sink.table).iterdir())) == 3
    assert spark.table(sink.table).count() == 6


def test_versioned_tables_append_and_replace_periods(spark, tmp_path):
    sink = new_sink(tmp_path, versioned=True)
    for _ in range(2):
        sink.create_or_append(days(spark, "2025-09-01", 2))
    sink.replace_period(days(spark, "2025-09-01", 1, tag="b"), date(2025, 9, 1), date(2025, 10, 1))
    assert tags(spark, sink) == {"b": 2}


def test_purge_keeps_what_is_in_use(spark, tmp_path):
    sink = new_sink(tmp_path)
    for n in range(1, 5):
        sink.replace(days(spark, "2025-09-01", n))
    assert sink.purge(spark, keep=1) == 2 and spark.table(sink.table).count() == 8


def files_by_date(spark, sink):
    rows = spark.table(sink.table).select("partitiondate", F.col("_metadata.file_path").alias("f")).distinct().groupBy("partitiondate").count()
    return {str(r.partitiondate): r["count"] for r in rows.collect()}


def test_compaction_packs_small_files_only(spark, tmp_path):
    sink = new_sink(tmp_path)
    for n in range(4):
        sink.create_or_append(days(spark, "2025-09-01", 2, tag=f"t{n}"))
    sink.create_or_append(days(spark, "2025-09-09", 1))
    before = sorted(map(tuple, spark.table(sink.table).collect()))
    assert sink.compact(spark, 1 << 20) == 2
    assert files_by_date(spark, sink) == {"2025-09-01": 1, "2025-09-02": 1, "2025-09-09": 1}
    assert sorted(map(tuple, spark.table(sink.table).collect())) == before
    assert sink.compact(spark, 1 << 20) == 0
    sink.create_or_append(days(spark, "2025-09-01", 1, tag="late"))
    assert files_by_date(spark, sink)["2025-09-01"] == 2 and spark.table(sink.table).count() == len(before) + 2
    sink.replace_period(days(spark, "2025-09-02", 1), date(2025, 9, 2), date(2025, 9, 3))
    assert spark.table(sink.table).where("partitiondate = '2025-09-02'").count() == 2
    assert sink.compact(spark, 1) == 0
    flat = new_sink(tmp_path)
    flat.replace(spark.range(3))
    with pytest.raises(ValueError, match="no partitions"):
        flat.compact(spark)


def test_layout_narrows_every_column(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "id * 7919 % 20011 AS other", "date_add(DATE'2025-01-01', CAST(id * 31 % 365 AS INT)) AS day", "IF(id % 10 = 0, NULL, 1) AS hot")
    cluster_by_all(rows, ["id", "other", "hot"], 16).write.parquet(str(tmp_path / "z"))
    written = spark.read.parquet(str(tmp_path / "z"))
    assert written.columns == rows.columns and sorted(map(tuple, written.collect()), key=lambda r: r[0]) == sorted(map(tuple, rows.collect()), key=lambda r: r[0])
    for column in ("id", "other"):
        found = written.where(F.col(column) < 1000).select("_metadata.file_path").distinct().count()
        assert found <= 8
    bounds = column_bounds(rows, ["day", "hot"], 2)
    assert len(bounds["day"]) == 3 and bounds["hot"] == [1]
    assert cluster_by_all(rows.limit(0), ["id", "day"], 4).collect() == []
    with pytest.raises(ValueError, match="string"):
        cluster_by_all(rows.selectExpr("CAST(id AS STRING) AS s"), ["s"], 4)
