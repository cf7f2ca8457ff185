import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from costflow.operators.distribute import distribute_sorted, partition_sizes, spread
from costflow.sinks.files import describe, preview, write_report
from costflow.sinks.table import (
    APPEND_PROPERTIES,
    REPLACE_PROPERTIES,
    TableSink,
    create_database,
    list_databases,
    list_tables,
    table_exists,
)


@pytest.fixture(params=["located", "managed"])
def sink(request, tmp_path):
    location = str(tmp_path / "tables") if request.param == "located" else None
    return TableSink(f"t_{uuid.uuid4().hex[:10]}", location=location)


def rows(spark, sink, *columns):
    return sorted(tuple(r) for r in spark.table(sink.table).select(*columns).collect())


def days(spark, first, n, per_day=2, tag="a"):
    return spark.sql(
        f"SELECT id AS k, '{tag}' AS tag, date_add(DATE'{first}', CAST(id div {per_day} AS INT)) AS partitiondate "
        f"FROM range({n * per_day})"
    )


def test_replace_keeps_only_the_last_write(spark, sink):
    sink.replace(days(spark, "2025-09-01", 3))
    sink.replace(days(spark, "2025-10-01", 1).drop("tag"))
    table = spark.table(sink.table)
    assert table.columns == ["k", "partitiondate"]
    assert table.count() == 2
    assert spark.sql(f"SHOW PARTITIONS {sink.table}").count() == 1


def test_failed_replace_leaves_the_table_alone(spark, sink):
    sink.replace(days(spark, "2025-09-01", 3))
    bad = days(spark, "2025-10-01", 1).withColumn("tag", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException):
        sink.replace(bad)
    assert spark.table(sink.table).count() == 6


def test_sql_replace_equals_dataframe_replace(spark, sink):
    data = days(spark, "2025-09-01", 3)
    data.createOrReplaceTempView("sink_source")
    sink.replace_from_view(spark, "sink_source")
    assert rows(spark, sink, "k", "tag", "partitiondate") == sorted(tuple(r) for r in data.collect())
    assert spark.sql(f"SHOW PARTITIONS {sink.table}").count() == 3
    data.drop("partitiondate").createOrReplaceTempView("sink_source")
    sink.replace_from_view(spark, "sink_source")
    assert spark.table(sink.table).columns == ["k", "tag"]


def test_text_dates_are_cast(spark, sink):
    sink.replace(spark.sql("SELECT 1 AS k, '2025-09-01' AS partitiondate"))
    assert spark.table(sink.table).first().partitiondate == date(2025, 9, 1)


def test_append_adds_every_time_and_matches_by_name(spark, sink):
    first = days(spark, "2025-09-01", 1)
    sink.create_or_append(first)
    sink.create_or_append(first.select("partitiondate", "tag", "k"))
    assert rows(spark, sink, "k", "tag") == [(0, "a"), (0, "a"), (1, "a"), (1, "a")]


def period(first, past):
    return date.fromisoformat(first), date.fromisoformat(past)


SEPTEMBER = period("2025-09-01", "2025-10-01")
OCTOBER = period("2025-10-01", "2025-11-01")


def test_replace_period_is_idempotent(spark, sink):
    for _ in range(2):
        sink.replace_period(days(spark, "2025-09-01", 3), *SEPTEMBER)
        sink.replace_period(days(spark, "2025-10-01", 3, tag="b"), *OCTOBER)
    assert spark.table(sink.table).groupBy("tag").count().orderBy("tag").collect() == [("a", 6), ("b", 6)]


def test_replace_period_drops_dates_that_are_gone(spark, sink):
    sink.replace_period(days(spark, "2025-09-01", 5), *SEPTEMBER)
    sink.replace_period(days(spark, "2025-10-01", 2), *OCTOBER)
    sink.replace_period(days(spark, "2025-09-03", 1, tag="new").select("partitiondate", "tag", "k"), *SEPTEMBER)
    got = rows(spark, sink, "partitiondate", "tag", "k")
    assert [r for r in got if r[0].month == 9] == [(date(2025, 9, 3), "new", 0), (date(2025, 9, 3), "new", 1)]
    assert len(got) == 6
    # Also after the catalog looks at the folders again.
    spark.sql(f"MSCK REPAIR TABLE {sink.table}")
    assert rows(spark, sink, "partitiondate", "tag", "k") == got


def test_rows_outside_the_period_fail(spark, sink):
    sink.replace_period(days(spark, "2025-10-01", 1), *OCTOBER)
    with pytest.raises(PySparkException, match="outside the period"):
        sink.replace_period(days(spark, "2025-09-30", 2), *SEPTEMBER)
    assert spark.table(sink.table).count() == 2
    with pytest.raises(ValueError, match="partitiondate"):
        sink.replace_period(spark.range(1), *SEPTEMBER)


def test_missing_partition_dates_fail_too(spark, sink):
    blank = days(spark, "2025-09-01", 1).withColumn("partitiondate", F.lit(None).cast("date"))
    with pytest.raises(PySparkException, match="outside the period"):
        sink.replace_period(blank, *SEPTEMBER)


def test_other_columns_than_the_table_are_refused(spark, sink):
    september = days(spark, "2025-09-01", 2)
    sink.replace_period(september, *SEPTEMBER)
    for other in (september.withColumn("new", F.lit(1)), september.drop("tag")):
        with pytest.raises(ValueError, match="new|tag"):
            sink.replace_period(other, *SEPTEMBER)
        with pytest.raises(ValueError, match="new|tag"):
            sink.create_or_append(other)
    assert spark.table(sink.table).count() == 4


def test_v2_statement(spark):
    """No v2 catalog here, so only the text of the statement is checked."""

    class Spy:
        def table(self, name):
            return spark.table(name)

        def sql(self, text):
            self.text = text

    days(spark, "2025-09-01", 1).createOrReplaceTempView("v2_source")
    spy = Spy()
    sink = TableSink("lake.live.cost", fmt="iceberg")
    sink.replace_from_view(spy, "v2_source")
    assert spy.text.startswith(
        "CREATE OR REPLACE TABLE lake.live.cost USING iceberg PARTITIONED BY (`partitiondate`)"
    )
    for key, value in REPLACE_PROPERTIES.items():
        assert f"'{key}' = '{value}'" in spy.text
    assert spy.text.endswith("FROM `v2_source`")
    prepared = sink._prepared(days(spark, "2025-09-01", 1))
    assert "Rebalance" not in prepared._jdf.queryExecution().analyzed().toString()


def test_settings_are_left_as_they_were(spark, sink):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    for _ in range(2):
        sink.replace_period(days(spark, "2025-09-01", 2), *SEPTEMBER)
    assert spark.conf.get(key) == before


def test_properties_for_v2_tables():
    assert REPLACE_PROPERTIES["write.spark.fanout.enabled"] == "true"
    assert APPEND_PROPERTIES["write.target-file-size-bytes"] == str(128 * 1024 * 1024)
    assert {p["format-version"] for p in (REPLACE_PROPERTIES, APPEND_PROPERTIES)} == {"2"}


def test_files_are_zstd(spark, tmp_path):
    sink = TableSink(f"t_{uuid.uuid4().hex[:10]}", location=str(tmp_path))
    sink.replace(days(spark, "2025-09-01", 1))
    sink.replace_from_view(spark, sink.table)
    assert list(tmp_path.rglob("*.zstd.parquet"))
    assert not list(tmp_path.rglob("*.snappy.parquet"))


@pytest.mark.parametrize("copies", [False, True])
def test_a_hot_date_is_split_between_tasks(spark, setting, tmp_path, copies):
    """A date with a third of the rows does not end up in one task."""
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k" if copies else "1m")
    n = 200_000
    hot = F.col("id") % 3 == 0
    pad = F.lit("x") if copies else F.sha2(F.col("id").cast("string"), 256)
    df = spark.range(0, n, 1, 16).select(
        F.when(hot, 0).otherwise(F.col("id") % 29 + 1).alias("k"), pad.alias("pad")
    )
    placed = distribute_sorted(df, "k", partitions=8)
    placed.write.partitionBy("k").parquet(str(tmp_path / "out"))
    # One file per task and date.
    written = spark.read.parquet(str(tmp_path / "out")).where("k = 0")
    per_task = written.groupBy("_metadata.file_name").agg(F.count("*").alias("n")).collect()
    rows_of_hot = (n + 2) // 3
    assert sum(r.n for r in per_task) == rows_of_hot
    assert max(r.n for r in per_task) <= rows_of_hot / 3


def test_rows_are_sorted_inside_tasks(spark):
    df = distribute_sorted(days(spark, "2025-09-01", 30, per_day=50).orderBy(F.hash("k")), "partitiondate", partitions=4)
    numbered = df.select("partitiondate", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("p"))
    seen: dict[int, date] = {}
    for row in sorted(numbered.collect(), key=lambda r: r.at):
        assert seen.get(row.p, row.partitiondate) <= row.partitiondate
        seen[row.p] = row.partitiondate


def test_spread_makes_that_many_parts(spark):
    assert partition_sizes(spread(spark.range(1000), 16)).count() == 16


def test_catalog_helpers(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    create_database(spark, name)
    create_database(spark, name)
    assert name in [r[0] for r in list_databases(spark).collect()]
    TableSink(f"{name}.alpha").replace(spark.range(1))
    TableSink(f"{name}.beta").replace(spark.range(1))
    assert table_exists(spark, f"{name}.alpha") and not table_exists(spark, f"{name}.gamma")
    assert [r.tableName for r in list_tables(spark, name, "al*").collect()] == ["alpha"]
    assert list_tables(spark, name).count() == 2


def test_report_keeps_the_order(spark, tmp_path):
    lines = [f"line {n}" for n in range(50)]
    write_report(spark, lines, str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*")
    assert part.read_text().splitlines() == lines


def test_preview_and_describe(spark, capsys):
    assert [r.id for r in preview(spark.range(100).orderBy(F.desc("id")), 3, "id").collect()] == [0, 1, 2]
    assert preview(spark.range(100), 5).count() == 5
    describe(spark.range(3))
    assert "|-- id: long" in capsys.readouterr().out


def test_a_replace_cut_off_at_any_step_leaves_a_table(spark, tmp_path):
    from costflow.sinks.table import ASIDE, TableSink

    sink = TableSink("cut_off", location=str(tmp_path), partition_col=None)
    sink.replace(spark.range(3))
    spark.sql(f"ALTER TABLE cut_off RENAME TO cut_off{ASIDE}")  # lost after the first step
    sink.recover(spark)
    assert spark.table("cut_off").count() == 3
    sink._new_v1_writer(spark.range(1)).saveAsTable("cut_off" + ASIDE)  # lost before the last step
    sink.replace(spark.range(5))
    assert spark.table("cut_off").count() == 5 and not spark.catalog.tableExists("cut_off" + ASIDE)
    spark.sql("DROP TABLE cut_off")
