import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException

from costflow.jobs import month_period, parse, run
from costflow.operators.catalog import TargetSchema
from costflow.plans.chain import load_replace
from costflow.plans.health import preflight
from costflow.sinks.runlog import RunLog
from costflow.sinks.table import TableSink

DDL = """create table COST ("RecordId" INT, "AccountId" VARCHAR(40), "PartitionDate" DATE,
  "CostCurrencyVendorUSD_Cost" NUMBER(20,4), "Vendor" TEXT);"""


@pytest.fixture()
def ddl(tmp_path):
    path = tmp_path / "cost.sql"
    path.write_text(DDL)
    return str(path)


def test_months_to_periods():
    assert month_period("s3a://b/x/", "2025-09") == ("s3a://b/x/2025-09", date(2025, 9, 1), date(2025, 10, 1))
    assert month_period("b", "2025-12")[1:] == (date(2025, 12, 1), date(2026, 1, 1))


@pytest.mark.parametrize("form", ["dataframe", "sql"])
def test_generate_then_replace(spark, tmp_path, ddl, form):
    feed, table = str(tmp_path / "feed"), f"t_{uuid.uuid4().hex[:8]}"
    run(spark, parse(["generate", "--output", feed, "--rows", "60", "--files", "4"]))
    common = ["--source", feed, "--ddl", ddl, "--table", table, "--log", str(tmp_path / "log")]
    run(spark, parse(["replace", *common, "--form", form, "--missing", "fill"]))
    written = spark.table(table)
    assert written.count() == 60
    assert written.schema["costcurrencyvendorusd_cost"].dataType.simpleString() == "decimal(20,4)"
    assert "vendor" in written.columns and "status" in written.columns
    assert RunLog(spark, str(tmp_path / "log")).summaries(all_runs=True).first().output_count == 60


def test_periods_job(spark, tmp_path, ddl):
    run(spark, parse(["generate", "--output", str(tmp_path / "in" / "2025-09"), "--rows", "60"]))
    table = f"t_{uuid.uuid4().hex[:8]}"
    job = ["periods", "--source", str(tmp_path / "in"), "--ddl", ddl, "--table", table, "--months", "2025-09"]
    for _ in range(2):
        run(spark, parse([*job, "--location", str(tmp_path / "data"), "--log", str(tmp_path / "log")]))
    assert spark.table(table).count() == 60
    steps = RunLog(spark, str(tmp_path / "log")).markers(all_runs=True)
    assert steps.where("step = 'period_2025-09-01'").count() == 2


def test_jobs_that_check_split_ingest_and_pack(spark, tmp_path, ddl, capsys):
    feed, table = str(tmp_path / "feed"), f"t_{uuid.uuid4().hex[:8]}"
    run(spark, parse(["generate", "--output", feed, "--rows", "60", "--files", "4"]))
    common = lambda job, name: [job, "--source", feed, "--ddl", ddl, "--table", f"{table}_{name}", "--location", str(tmp_path / name)]
    run(spark, parse([*common("checked", "a"), "--drift", "fill", "--max-rejected", "0", "--log", str(tmp_path / "log")]))
    assert "vendor" in spark.table(f"{table}_a").columns and "missing" in capsys.readouterr().out
    run(spark, parse([*common("split", "b"), "--rejects", f"{table}_bad"]))
    assert "60 rows loaded, 0 set aside" in capsys.readouterr().out
    for _ in range(2):
        run(spark, parse([*common("ingest", "c"), "--checkpoint", str(tmp_path / "state")]))
    assert spark.table(f"{table}_c").count() == 60
    run(spark, parse(["files", "--source", feed, "--deep"]))
    run(spark, parse(["compact", "--table", f"{table}_a", "--location", str(tmp_path / "a")]))
    assert "0 partitions packed" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        run(spark, parse(["split", "--source", feed, "--table", "t", "--rejects", "r"]))


def test_a_failed_load_leaves_a_marker(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    bad = spark.sql("SELECT 'abc' AS n")
    with pytest.raises(PySparkException):
        load_replace(spark, bad, TargetSchema.of([("n", "int")]), TableSink(f"t_{uuid.uuid4().hex[:8]}"), log)
    assert [r.step for r in log.markers().orderBy("seq").collect()][-1] == "failed"


def test_preflight_reports_instead_of_raising(spark, tmp_path, ddl):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    database = f"db_{uuid.uuid4().hex[:8]}"
    good = preflight(spark, str(tmp_path / "in"), ddl, database).collect()
    assert [(r.check, r.ok) for r in good] == [
        ("ddl_file", True), ("ddl_columns", True), ("source", True), ("database", True)
    ]
    assert good[1].detail == "5 columns"
    bad = preflight(spark, str(tmp_path / "none"), str(tmp_path / "none.sql"), "no such name").collect()
    assert [r.ok for r in bad] == [False] * 4
    assert bad[2].detail == "PATH_NOT_FOUND"
