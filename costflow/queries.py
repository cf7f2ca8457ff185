"""The registered queries, each with the SQL that checks it.

Every query reads whole given tables, or a feed Spark derives from them, and
returns flat columns. Writes go to fresh folders on shared storage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costflow import inputs
from costflow.functions.epoch import epoch_to_ntz
from costflow.functions.sizes import human_bytes
from costflow.inputs import COST_FEED_DDL, EVENT_FEED_DDL, TABLE_KEYS, table
from costflow.operators.catalog import map_types, parse_ddl, target_from_text
from costflow.operators.conform import cast_rejects, conform, schema_report
from costflow.operators.distribute import distribute_sorted, partition_sizes, rebalance, spread
from costflow.operators.flatten import flatten_append, flatten_in_place
from costflow.operators.layout import cluster_by_all, partition_last
from costflow.operators.names import lowercase_nested, lowercase_top
from costflow.plans.chain import flattened, load_periods, load_replace, load_replace_sql, standardize
from costflow.plans.feed import feed_of
from costflow.plans.health import file_health, health_check
from costflow.plans.quarantine import load_quarantined
from costflow.plans.report import load_checked
from costflow.plans.restart import run_stages
from costflow.scratch import scratch_dir
from costflow.sinks.files import overwrite_parquet, preview, write_report, write_text
from costflow.sinks.runlog import RunLog
from costflow.sinks.table import FILE_SIZE, TableSink, create_database, list_tables, table_exists
from costflow.sources.files import file_attributes, file_inventory
from costflow.sources.footers import file_footers
from costflow.sources.parquet import (
    row_count,
    scan_folder,
    scan_periods,
    scan_recursive,
    scan_table,
    scan_widened,
    with_source_file,
)
from costflow.sources.text import scan_lines, scan_statements
from costflow.streaming.incremental import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return add


# -- pieces of the checking SQL ------------------------------------------------


def sql_epoch(stamp: str, unit: str) -> str:
    return f"""CASE {unit} WHEN 0 THEN epoch_us({stamp}) // 1000000
        WHEN 1 THEN epoch_us({stamp}) // 1000 WHEN 2 THEN epoch_us({stamp})
        ELSE epoch_us({stamp}) * 1000 END"""


def sql_repair(value: str, micros: bool = False) -> str:
    """By number of digits, as the rule is worded."""

    def branch(per_second: int) -> str:
        guard = f"{value} BETWEEN {946684800 * per_second} AND {4102444800 * per_second}"
        if not micros:
            scaled = f"({value} // {per_second}) * 1000000"
        elif per_second > 1000000:
            scaled = f"{value} // {per_second // 1000000}"
        else:
            scaled = f"{value} * {1000000 // per_second}"
        return f"CASE WHEN {guard} THEN {scaled} END"

    return f"""make_timestamp(CAST(CASE length(CAST({value} AS VARCHAR))
        WHEN 19 THEN {branch(10**9)} WHEN 16 THEN {branch(10**6)}
        WHEN 10 THEN {branch(1)} ELSE {branch(10**3)} END AS BIGINT))"""


FLAT_COST_SQL = f"""
SELECT l_orderkey AS recordid,
       'acct-' || l_suppkey AS accountid,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS partitiondate,
       l_extendedprice * (1 - l_discount) AS costcurrencyvendorusd_adjustedamortizedcost,
       l_extendedprice AS costcurrencyvendorusd_cost,
       'USD' AS costcurrencyvendorusd_currencycode,
       CASE WHEN l_tax > 0 THEN l_extendedprice * (1 + l_tax) END
         AS costcurrencyvendorraw_adjustedamortizedcost,
       CASE WHEN l_tax > 0 THEN l_extendedprice END AS costcurrencyvendorraw_cost,
       CASE WHEN l_tax > 0 THEN 'EUR' END AS costcurrencyvendorraw_currencycode,
       {sql_epoch("l_shipdate", "(l_linenumber % 4)")} AS usagestarttime,
       strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d') AS usageendtime,
       CAST(month(l_shipdate) AS INTEGER) AS month,
       l_linenumber % 2 AS mspexposetoendcustomers,
       l_partkey AS id
FROM lineitem"""

TYPED_COST_SQL = f"""
SELECT * REPLACE (
  {sql_repair("usagestarttime")} AS usagestarttime,
  CAST(usageendtime AS TIMESTAMP) AS usageendtime,
  CAST(month AS VARCHAR) AS month,
  CAST(mspexposetoendcustomers AS BOOLEAN) AS mspexposetoendcustomers,
  CAST(id AS VARCHAR) AS id)
FROM ({FLAT_COST_SQL})"""

FLAT_EVENT_SQL = f"""
SELECT event_id AS eventid,
       CAST(ts AS DATE) AS partitiondate,
       {sql_epoch("ts", "(event_id % 4)")} AS usagestarttime,
       date_trunc('second', ts) AS usageendtime,
       user_id AS userid,
       value,
       CAST(event_id % 2 AS INTEGER) AS flag,
       event_type AS eventtype
FROM events"""

TYPED_EVENT_SQL = f"""
SELECT * REPLACE (
  CAST(eventid AS VARCHAR) AS eventid,
  {sql_repair("usagestarttime")} AS usagestarttime,
  CAST(userid AS VARCHAR) AS userid,
  CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS value,
  CAST(flag AS BOOLEAN) AS flag)
FROM ({FLAT_EVENT_SQL})"""

DATED_EVENTS_SQL = """
SELECT event_id, ts, CAST(ts AS DATE) AS partitiondate, user_id, event_type, value, props FROM events"""

ROWS_PER_DATE_SQL = f"""
SELECT partitiondate, count(*) AS row_count FROM ({DATED_EVENTS_SQL}) GROUP BY partitiondate"""


# -- pieces of the queries -----------------------------------------------------


def plain(df: DataFrame) -> DataFrame:
    """Decimals as text, so that both engines print them alike."""
    decimals = {f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"}
    return df.select(*(F.col(c).cast("string") if c in decimals else F.col(c) for c in df.columns))


def fresh_sink(spark: SparkSession, label: str, **options) -> TableSink:
    name = f"costflow_{label}_{uuid.uuid4().hex[:12]}"
    return TableSink(name, location=scratch_dir(spark, label), **options)


def rows_per_date(df: DataFrame) -> DataFrame:
    return df.groupBy("partitiondate").agg(F.count("*").alias("row_count"))


def event_weeks(spark: SparkSession, sf_dir: str) -> tuple[str, list[date]]:
    """The event feed written as one folder per week."""
    feed = inputs.event_feed(spark, sf_dir)
    base = scratch_dir(spark, "event_weeks")
    inputs.write_by_week(feed, "PartitionDate", base)
    return base, inputs.weeks_of(feed, "PartitionDate")


def as_periods(base: str, weeks: list[date]) -> list[tuple[str, date, date]]:
    return [(f"{base}/week={w}", w, w + timedelta(days=7)) for w in weeks]


# -- names and structs ---------------------------------------------------------


@registered(f"""
SELECT recordid, accountid, partitiondate, usagestarttime,
       usageendtime, month, mspexposetoendcustomers, id,
       costcurrencyvendorusd_adjustedamortizedcost AS usd_adjusted,
       costcurrencyvendorusd_cost AS usd_cost,
       costcurrencyvendorusd_currencycode AS usd_code,
       costcurrencyvendorraw_adjustedamortizedcost AS raw_adjusted,
       costcurrencyvendorraw_cost AS raw_cost,
       costcurrencyvendorraw_currencycode AS raw_code,
       costcurrencyvendorraw_cost IS NOT NULL AS has_raw
FROM ({FLAT_COST_SQL})""")
def lowercase_nested_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names at every depth; a null struct stays null."""
    return lowercase_nested(inputs.cost_feed(spark, sf_dir)).select(
        "recordid",
        "accountid",
        "partitiondate",
        "usagestarttime",
        "usageendtime",
        "month",
        "mspexposetoendcustomers",
        "id",
        F.col("costcurrencyvendorusd.adjustedamortizedcost").alias("usd_adjusted"),
        F.col("costcurrencyvendorusd.cost").alias("usd_cost"),
        F.col("costcurrencyvendorusd.currencycode").alias("usd_code"),
        F.col("costcurrencyvendorraw.adjustedamortizedcost").alias("raw_adjusted"),
        F.col("costcurrencyvendorraw.cost").alias("raw_cost"),
        F.col("costcurrencyvendorraw.currencycode").alias("raw_code"),
        F.col("costcurrencyvendorraw").isNotNull().alias("has_raw"),
    )


@registered("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def lowercase_top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return lowercase_top(events.toDF(*(c.upper() for c in events.columns)))


@registered("""
WITH each AS (
  SELECT vec_id, label, unnest(range(len(embedding))) AS position, unnest(embedding) AS value FROM embeddings)
SELECT vec_id, label, CAST(position AS INTEGER) AS position, CAST(value AS DOUBLE) AS value FROM each""")
def lowercase_in_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs inside an array renamed on request; arrays pass through whole."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("Vec_Id"),
        F.col("label").alias("Label"),
        F.transform("embedding", lambda x: F.struct(x.alias("Value"))).alias("Embedding"),
    )
    lower = lowercase_nested(vectors, into_collections=True)
    each = lower.select("vec_id", "label", F.posexplode("embedding.value").alias("position", "value"))
    return each.withColumn("value", F.col("value").cast("double"))


@registered(FLAT_COST_SQL)
def flatten_at_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_append(lowercase_nested(inputs.cost_feed(spark, sf_dir)))


@registered(FLAT_COST_SQL)
def flatten_in_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_in_place(lowercase_top(inputs.cost_feed(spark, sf_dir)))


@registered(DATED_EVENTS_SQL)
def partition_column_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.dated_events(spark, sf_dir)
    return partition_last(events.withColumn("partitiondate", F.col("partitiondate").cast("string")))


# -- types ---------------------------------------------------------------------


@registered(f"""
SELECT eventid AS event_id, {sql_repair("usagestarttime")} AS fixed,
       {sql_repair("usagestarttime", micros=True)} AS fixed_micros
FROM ({FLAT_EVENT_SQL})""")
def epoch_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.event_feed(spark, sf_dir).select(
        F.col("EventId").alias("event_id"),
        epoch_to_ntz("UsageStartTime").alias("fixed"),
        epoch_to_ntz("UsageStartTime", precision="micros").alias("fixed_micros"),
    )


@registered(f"""
SELECT recordid, usagestarttime AS epoch, {sql_repair("usagestarttime")} AS fixed
FROM ({FLAT_COST_SQL})""")
def epoch_repair_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates around the guard: before 2000 and before 2001-09-09 most units are null."""
    return inputs.cost_feed(spark, sf_dir).select(
        F.col("RecordId").alias("recordid"),
        F.col("UsageStartTime").alias("epoch"),
        epoch_to_ntz("UsageStartTime").alias("fixed"),
    )


@registered(f"SELECT *, CAST(NULL AS VARCHAR) AS vendor FROM ({TYPED_EVENT_SQL})")
def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = target_from_text(spark, EVENT_FEED_DDL)
    feed = lowercase_top(inputs.event_feed(spark, sf_dir))
    return plain(conform(feed, target, missing="fill"))


# Type texts by `p_partkey % 20`, with p = p_partkey % 45 + 1 and s = p_size % 12.
TYPE_TEXTS = """
'FLOAT', 'double precision', 'REAL', 'smallint', 'text', concat('VARCHAR(', p, ')'),
'CHAR', 'BOOLEAN', 'BOOLEAN NOT NULL', ' date ', 'Timestamp_tz', 'TIMESTAMP_NTZ(9)',
concat('NUMBER(', p, ')'), concat('NUMBER(', p, ',0) NOT NULL'),
concat('NUMBER(', p, ', ', s, ')'), concat('DECIMAL(', p, ',', s, ')'),
concat('numeric(', p, ')'), 'NUMBER', 'DECIMAL', 'VARIANT'"""


@registered(f"""
WITH given AS (
  SELECT p_partkey, p_partkey % 45 + 1 AS p, p_size % 12 AS s, p_partkey % 20 AS kind FROM part),
texts AS (
  SELECT *, list_extract([{TYPE_TEXTS}], kind + 1) AS type_text,
         'decimal(' || least(p, 38) || ',0)' AS whole,
         'decimal(' || least(p, 38) || ',' || least(s, 38) || ')' AS scaled,
         CASE WHEN p <= 9 THEN 'int' WHEN p <= 18 THEN 'bigint' END AS narrow
  FROM given)
SELECT p_partkey, type_text,
       CASE WHEN kind <= 2 THEN 'double' WHEN kind = 3 THEN 'bigint' WHEN kind <= 6 THEN 'string'
            WHEN kind = 7 THEN 'boolean' WHEN kind = 8 THEN 'string' WHEN kind = 9 THEN 'date'
            WHEN kind <= 11 THEN 'timestamp_ntz'
            WHEN kind <= 13 THEN coalesce(narrow, whole)
            WHEN kind = 14 AND s = 0 THEN coalesce(narrow, whole)
            WHEN kind <= 15 THEN scaled WHEN kind = 16 THEN whole WHEN kind = 17 THEN 'bigint'
            ELSE 'string' END AS spark_type,
       kind NOT IN (8, 18, 19) AS recognized
FROM texts""")
def type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_partkey % 45 + 1 AS p", "p_size % 12 AS s"
    ).selectExpr("p_partkey", f"elt(int(p_partkey % 20) + 1, {TYPE_TEXTS}) AS type_text")
    return map_types(texts)


@registered("""
WITH items AS (
  SELECT 'SHOP.PART_' || p_partkey AS table_name, p_size AS size, p_name, unnest(range(1, 6)) AS ordinal
  FROM part)
SELECT table_name, CAST(ordinal AS INTEGER) AS ordinal,
       CASE ordinal WHEN 1 THEN p_name || ', (net)' WHEN 2 THEN 'BRAND' WHEN 3 THEN 'Price'
         WHEN 4 THEN 'Price Class' ELSE 'Sold' END AS name,
       CASE ordinal WHEN 1 THEN 'NUMBER(' || (size % 38 + 1) || ',0)'
         WHEN 2 THEN 'VARCHAR(' || size || ') COMMENT'
         WHEN 3 THEN 'NUMBER(38, ' || (size % 10) || ') NOT NULL'
         WHEN 4 THEN 'DECIMAL' ELSE 'BOOLEAN' END AS type_text,
       CASE ordinal WHEN 1 THEN CASE WHEN size % 38 + 1 <= 9 THEN 'int'
           WHEN size % 38 + 1 <= 18 THEN 'bigint' ELSE 'decimal(' || (size % 38 + 1) || ',0)' END
         WHEN 3 THEN 'decimal(38,' || (size % 10) || ')'
         WHEN 5 THEN 'boolean' ELSE 'string' END AS spark_type
FROM items""")
def ddl_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of CREATE TABLE texts, written as text files, read and parsed."""
    path = scratch_dir(spark, "ddl")
    write_text(inputs.part_ddl(spark, sf_dir), path, line_sep=";")
    catalog = parse_ddl(scan_statements(spark, path))
    return map_types(catalog).drop("recognized")


@registered(f"""
WITH feed AS ({FLAT_EVENT_SQL}), n AS (SELECT count(*) AS rows FROM feed)
SELECT v.*, CASE WHEN status <> 'missing' THEN rows END AS row_count,
       CASE WHEN status <> 'missing' THEN rows END AS filled,
       CASE WHEN status <> 'missing' THEN CAST(0 AS BIGINT) END AS rejected
FROM n, (VALUES
  ('eventid', 'bigint', 'string', 'cast'), ('partitiondate', 'date', 'date', 'same'),
  ('usagestarttime', 'bigint', 'timestamp_ntz', 'epoch'),
  ('usageendtime', 'string', 'timestamp_ntz', 'cast'),
  ('userid', 'bigint', 'decimal(38,0)', 'cast'), ('value', 'double', 'decimal(12,2)', 'cast'),
  ('flag', 'int', 'boolean', 'cast'), ('eventtype', 'string', NULL, 'extra'),
  ('vendor', NULL, 'string', 'missing')) AS v(name, source_type, target_type, status)""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, extra and changed columns, with counts from one pass over the feed."""
    feed = lowercase_top(inputs.event_feed(spark, sf_dir))
    return schema_report(feed, target_from_text(spark, EVENT_FEED_DDL), profile=True)


REJECT_DDL = """CREATE TABLE REJECTS (
  "Code" BIGINT, "Value" NUMBER(4,2), "Props" DOUBLE, "Stamp" TIMESTAMP_NTZ, "User_Id" TIMESTAMP_NTZ);"""


@registered("""
WITH feed AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1 THEN CAST(user_id AS VARCHAR)
         END AS code, value, props, user_id FROM events)
SELECT 'code' AS name, 'bigint' AS target_type, count(code) AS filled,
       count(code) - count(TRY_CAST(code AS BIGINT)) AS rejected FROM feed
UNION ALL SELECT 'value', 'decimal(4,2)', count(value),
       count(value) - count(TRY_CAST(value AS DECIMAL(4,2))) FROM feed
UNION ALL SELECT 'props', 'double', count(props), count(props) - count(TRY_CAST(props AS DOUBLE)) FROM feed
UNION ALL SELECT 'stamp', 'timestamp_ntz', count(code), count(code) FROM feed
UNION ALL SELECT 'user_id', 'timestamp_ntz', count(user_id), count(user_id) FROM feed""")
def cast_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).when(
        F.col("event_id") % 3 == 1, F.col("user_id").cast("string")
    )
    feed = table(spark, sf_dir, "events").select(
        code.alias("code"), "value", "props", F.concat(F.lit("at "), code).alias("stamp"), "user_id"
    )
    return cast_rejects(feed, target_from_text(spark, REJECT_DDL))


# -- row placement -------------------------------------------------------------


@registered(f"SELECT *, true AS in_order FROM ({ROWS_PER_DATE_SQL})")
def distribute_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date, and whether no row of the date follows a later date inside its task."""
    placed = distribute_sorted(inputs.dated_events(spark, sf_dir), "partitiondate", partitions=32).select(
        "partitiondate", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("position")
    )
    before = F.lag("partitiondate").over(Window.partitionBy("task").orderBy("position"))
    checked = placed.select("partitiondate", F.coalesce(before <= F.col("partitiondate"), F.lit(True)).alias("in_order"))
    return checked.groupBy("partitiondate").agg(F.count("*").alias("row_count"), F.bool_and("in_order").alias("in_order"))


@registered(ROWS_PER_DATE_SQL)
def distribute_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_date(rebalance(inputs.dated_events(spark, sf_dir), "partitiondate"))


@registered("""
SELECT 16 AS partitions, count(*) AS row_count, true AS even FROM lineitem""")
def distribute_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen parts whose sizes differ by next to nothing."""
    sizes = partition_sizes(spread(table(spark, sf_dir, "lineitem"), 16))
    return sizes.agg(
        F.count("*").cast("int").alias("partitions"),
        F.sum("row_count").alias("row_count"),
        (F.max("row_count") <= F.min("row_count") * 1.1).alias("even"),
    )


# -- scans and plain files -----------------------------------------------------


@registered("SELECT * FROM orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "roundtrip")
    overwrite_parquet(table(spark, sf_dir, "orders"), path)
    overwrite_parquet(table(spark, sf_dir, "orders"), path)
    return scan_folder(spark, path)


@registered("SELECT count(*) AS row_count FROM orders")
def scan_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "orders"))


@registered("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_any_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files two folders down; the folder columns are not discovered."""
    path = scratch_dir(spark, "nested")
    events = inputs.dated_events(spark, sf_dir)
    by_type = events.withColumn("kind", F.col("event_type"))
    overwrite_parquet(rebalance(by_type, "partitiondate"), path, "partitiondate", "kind")
    return scan_recursive(spark, path)


@registered(f"""
SELECT f.* REPLACE (CASE WHEN eventid % 2 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS usageendtime)
FROM ({FLAT_EVENT_SQL}) f JOIN events ON eventid = event_id""")
def scan_all_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per week, read by a list of weeks as one scan."""
    base, weeks = event_weeks(spark, sf_dir)
    feed = scan_periods(spark, base, [str(w) for w in weeks], folder="week={}")
    return lowercase_top(feed)


@registered("""
SELECT event_id, user_id, event_type,
  CASE WHEN date_diff('week', DATE '2024-01-01', CAST(ts AS DATE)) % 2 = 0 THEN value END AS value FROM events""")
def scan_drifting_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second week lacks a column; the scan over all weeks has it."""
    path = scratch_dir(spark, "drift")
    events = inputs.dated_events(spark, sf_dir)
    week = F.floor(F.datediff(F.date_trunc("week", "partitiondate"), F.lit(date(2024, 1, 1))) / 7)
    even = F.pmod(week, F.lit(2)) == 0
    plain_columns = ["event_id", "user_id", "event_type", "partitiondate"]
    overwrite_parquet(events.where(even).select(*plain_columns, "value"), f"{path}/even", "partitiondate")
    overwrite_parquet(events.where(~even).select(*plain_columns), f"{path}/odd", "partitiondate")
    return scan_periods(spark, path, ["odd", "even"]).select("event_id", "user_id", "event_type", "value")


@registered("""
WITH mixed AS (SELECT event_id, ts, value, date_diff('week', DATE '2024-01-01', CAST(ts AS DATE)) % 3 AS kind FROM events)
SELECT event_id, CAST(CASE kind WHEN 0 THEN floor(value) ELSE CAST(value AS DECIMAL(12,2)) END AS DOUBLE) AS value,
  CASE kind WHEN 0 THEN 'whole' WHEN 1 THEN 'double' ELSE 'text' END AS kind,
  CASE kind WHEN 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE date_trunc('second', ts) END AS at,
  CASE kind WHEN 0 THEN NULL ELSE event_id % 7 END AS part FROM mixed""")
def scan_disagreeing_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks whose files hold one column as whole numbers, doubles and texts, and others as dates and times, in one scan."""
    path = scratch_dir(spark, "types")
    events = inputs.dated_events(spark, sf_dir)
    week = F.floor(F.datediff(F.date_trunc("week", "partitiondate"), F.lit(date(2024, 1, 1))) / 7)
    money, stamp = F.col("value").cast("decimal(12,2)"), F.date_trunc("second", "ts").cast("timestamp_ntz")
    part = F.col("event_id") % 7
    kinds = [
        [F.floor("value").cast("int").alias("value"), F.lit("whole").alias("kind"), F.col("partitiondate").alias("at")],
        [money.cast("double").alias("Value"), F.lit("double").alias("kind"), stamp.alias("at"), part.cast("int").alias("part")],
        [money.cast("string").alias("value"), F.lit("text").alias("kind"), stamp.alias("at"), part.cast("bigint").alias("part")],
    ]
    for n, columns in enumerate(kinds):
        events.where(F.pmod(week, F.lit(3)) == n).select("event_id", *columns, "partitiondate").write.partitionBy("partitiondate").parquet(f"{path}/{n}")
    scanned = scan_widened(spark, path)
    return scanned.select("event_id", F.col("value").cast("double").alias("value"), "kind", "at", "part")


@registered("SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts written as text files and scanned as lines."""
    path = scratch_dir(spark, "text")
    write_text(table(spark, sf_dir, "documents").select(F.col("text").alias("value")), path)
    return scan_lines(spark, path)


@registered("SELECT o_orderkey, 'orders.parquet' AS file_name, true AS has_size FROM orders")
def row_file_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file each row came from; its size and time are those of the inventory."""
    files = file_attributes(spark, f"{sf_dir}/orders.parquet").select("length", F.col("modified"))
    rows = with_source_file(table(spark, sf_dir, "orders"))
    # The inventory is one row here, which makes the join a lookup.
    known = rows.join(F.broadcast(files), [F.col("file_size") == F.col("length"), F.col("file_modified") == F.col("modified")], "left")
    return known.select("o_orderkey", F.regexp_extract("file_path", "[^/]+$", 0).alias("file_name"), F.col("length").isNotNull().alias("has_size"))


def keys_as_text(spark: SparkSession, sf_dir: str) -> str:
    """The order keys as lines of text: seven files a folder, a folder for each priority."""
    path = scratch_dir(spark, "keys")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"), F.substring("o_orderpriority", 1, 1).alias("level"))
    slot = F.pmod(F.xxhash64("value"), F.lit(7))
    # One task a slot; with hundreds of keys a level, each folder gets a file from every one of the seven.
    dealt = orders.withColumn("slot", slot.cast("int")).repartitionById(7, "slot").drop("slot")
    dealt.write.partitionBy("level").option("compression", "none").text(path)
    return path


_KEY_BYTES_SQL = """
SELECT substr(o_orderpriority, 1, 1) AS level, CAST(7 AS BIGINT) AS n_files, CAST(sum(strlen(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS total_bytes
FROM orders GROUP BY level"""


@registered(f"""
WITH total AS (SELECT CAST(sum(n_files) AS BIGINT) AS n_files, CAST(sum(total_bytes) AS BIGINT) AS total_bytes FROM ({_KEY_BYTES_SQL}))
SELECT n_files, total_bytes, CASE WHEN total_bytes < 1024 THEN printf('%.2f B', total_bytes / 1.0::DOUBLE)
  WHEN total_bytes < 1048576 THEN printf('%.2f KB', total_bytes / 1024.0::DOUBLE)
  ELSE printf('%.2f MB', total_bytes / 1048576.0::DOUBLE) END AS total_size FROM total""")
def file_inventory_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes below a folder, at any depth, in one row."""
    return file_inventory(spark, keys_as_text(spark, sf_dir), suffix=".txt").drop("path")


@registered(f"SELECT level, unnest(range(n_files)) AS file_no, true AS named, true AS fresh FROM ({_KEY_BYTES_SQL})")
def file_attribute_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file: its folder, its number there, and whether name and time are those of a file just written."""
    files = file_attributes(spark, keys_as_text(spark, sf_dir), suffix=".txt")
    level = F.regexp_extract("path", "level=([^/]+)/", 1)
    number = F.row_number().over(Window.partitionBy("level").orderBy("path")) - 1
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("modified")
    listed = files.select(level.alias("level"), "path", F.col("path").rlike("/part-[0-9]{5}-[^/]*[.]txt$").alias("named"), age.between(-60, 3600).alias("fresh"))
    return listed.select("level", number.cast("bigint").alias("file_no"), "named", "fresh")


@registered(f"SELECT level AS folder, n_files, total_bytes FROM ({_KEY_BYTES_SQL})")
def file_inventory_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and bytes of the files of each folder, from their attributes alone."""
    level = F.regexp_extract("path", "level=([^/]+)/", 1)
    return (
        file_attributes(spark, keys_as_text(spark, sf_dir), suffix=".txt")
        .groupBy(level.alias("folder"))
        .agg(F.count("*").alias("n_files"), F.sum("length").alias("total_bytes"))
    )


@registered(f"""
SELECT CAST(partitiondate AS VARCHAR) AS folder, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows
FROM ({DATED_EVENTS_SQL}) GROUP BY partitiondate""")
def file_inventory_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per date folder, and the rows that their footers tell, without reading one."""
    path = scratch_dir(spark, "by_date")
    events = inputs.dated_events(spark, sf_dir).repartition(8, "partitiondate")
    overwrite_parquet(events, path, "partitiondate")
    folder = F.regexp_extract("path", "partitiondate=([^/]+)/", 1)
    return file_footers(spark, path).groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"))


@registered("""
SELECT lang AS folder, true AS has_files, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS total_bytes
FROM documents GROUP BY lang""")
def file_bytes_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact bytes per folder of plain text files, from their attributes alone."""
    path = scratch_dir(spark, "text_by_lang")
    texts = table(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("value"), "lang")
    texts.write.partitionBy("lang").option("compression", "none").text(path)
    folder = F.regexp_extract("path", "lang=([^/]+)/", 1)
    return (
        file_attributes(spark, path, suffix=".txt")
        .groupBy(folder.alias("folder"))
        .agg((F.count("*") > 0).alias("has_files"), F.sum("length").alias("total_bytes"))
    )


@registered("""
WITH sizes AS (
  SELECT CAST(floor(l_extendedprice) AS BIGINT) * CAST(pow(100, l_linenumber - 1) AS BIGINT) AS n
  FROM lineitem)
SELECT n AS size,
       CASE WHEN n < 1024 THEN printf('%.2f B', n / 1.0::DOUBLE)
            WHEN n < 1048576 THEN printf('%.2f KB', n / 1024.0::DOUBLE)
            WHEN n < 1073741824 THEN printf('%.2f MB', n / 1048576.0::DOUBLE)
            WHEN n < 1099511627776 THEN printf('%.2f GB', n / 1073741824.0::DOUBLE)
            WHEN n < 1125899906842624 THEN printf('%.2f TB', n / 1099511627776.0::DOUBLE)
            ELSE printf('%.2f PB', n / 1125899906842624.0::DOUBLE) END AS shown
FROM sizes""")
def human_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from bytes to petabytes."""
    scale = F.pow(F.lit(100.0), F.col("l_linenumber") - 1).cast("bigint")
    size = F.floor("l_extendedprice") * scale
    sizes = table(spark, sf_dir, "lineitem").select(size.alias("size"))
    return sizes.select("size", human_bytes(F.col("size")).alias("shown"))


@registered("SELECT * FROM events ORDER BY event_id LIMIT 10")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten-row report: a top-k over the whole table, not a sort of it."""
    return preview(table(spark, sf_dir, "events"), 10, "event_id")


# -- tables --------------------------------------------------------------------


@registered(DATED_EVENTS_SQL)
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write wins, also where it has other columns than the first."""
    sink = fresh_sink(spark, "replace")
    events = inputs.dated_events(spark, sf_dir)
    sink.replace(events.drop("value"))
    sink.replace(events)
    return scan_table(spark, sink.table)


@registered(DATED_EVENTS_SQL)
def replace_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = fresh_sink(spark, "replace_sql")
    view = f"{sink.table}_source"
    inputs.dated_events(spark, sf_dir).createOrReplaceTempView(view)
    sink.replace_from_view(spark, view)
    sink.replace_from_view(spark, view)
    return scan_table(spark, sink.table)


@registered("SELECT * FROM customer")
def write_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No partition column, so no partitions; scan and replace, nothing between."""
    sink = fresh_sink(spark, "flat")
    sink.replace(table(spark, sf_dir, "customer"))
    return scan_table(spark, sink.table)


@registered("SELECT o_orderkey, o_custkey, 3 AS version FROM orders")
def replace_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions behind one view; older ones are purged but for the last."""
    sink = fresh_sink(spark, "versioned", versioned=True)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    for version in (1, 2, 3):
        sink.replace(orders.withColumn("version", F.lit(version)))
    sink.purge(spark, keep=1)
    return scan_table(spark, sink.table)


@registered("""
SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS partitiondate, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
  true AS fewer_files FROM orders GROUP BY 1""")
def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five loads leave five small files a quarter; after packing there is one, with the same rows."""
    sink = fresh_sink(spark, "compacted", properties={FILE_SIZE: str(8 << 20)})
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("partitiondate"))
    for n in range(5):
        sink.create_or_append(orders.where(F.col("o_orderkey") % 5 == n))
    sink.compact(spark)
    packed = scan_table(spark, sink.table).withColumn("file", F.col("_metadata.file_path"))
    return packed.groupBy("partitiondate").agg(
        F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum"), (F.count_distinct("file") == 1).alias("fewer_files")
    )


@registered("SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, true AS fewer FROM lineitem WHERE l_suppkey * 10 <= (SELECT max(s_suppkey) FROM supplier)")
def clustered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter for a tenth of the second column of the layout; `fewer`: its rows are in under half of the files."""
    path = scratch_dir(spark, "clustered")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    cluster_by_all(lines, ["l_orderkey", "l_suppkey"], 16).write.parquet(path)
    most = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0] // 10
    found = scan_folder(spark, path).where(F.col("l_suppkey") <= most)
    files = found.select(F.count_distinct(F.col("_metadata.file_path")).alias("n"))
    return found.join(F.broadcast(files.select((F.col("n") * 2 < 16).alias("fewer"))))


@registered("""
SELECT * FROM (VALUES ('write.target-file-size-bytes', '1048576'), ('write.parquet.compression-codec', 'snappy'), ('codec of files', 'snappy')) AS v(key, value)
WHERE (SELECT count(*) FROM customer) > 0""")
def table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of a table on the built-in backend, and the codec its files are named for."""
    given = {FILE_SIZE: str(1 << 20), "write.parquet.compression-codec": "snappy"}
    sink = fresh_sink(spark, "properties", properties=given)
    sink.replace(table(spark, sf_dir, "customer"))
    listed = spark.sql(f"SHOW TBLPROPERTIES {sink.table}").where(F.col("key").isin(*given))
    codec = F.regexp_extract(F.col("_metadata.file_path"), "[.]([a-z]+)[.]parquet$", 1)
    written = scan_table(spark, sink.table).select(F.lit("codec of files").alias("key"), codec.alias("value")).distinct()
    return listed.select("key", "value").unionByName(written)


@registered("""
SELECT 'region' AS table_name, true AS found, count(*) AS row_count FROM region
UNION ALL SELECT 'nation', true, count(*) FROM nation UNION ALL SELECT 'report', true, CAST(2 AS BIGINT)
UNION ALL SELECT 'customer', false, NULL""")
def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new database, two tables in it found by pattern, one that is not there, and a text report of both."""
    database = f"costflow_{uuid.uuid4().hex[:12]}"
    create_database(spark, database, scratch_dir(spark, "database"))
    for name in ("region", "nation"):
        TableSink(f"{database}.load_{name}").replace(table(spark, sf_dir, name))
    listed = list_tables(spark, database, "load_*").select(F.col("tableName").alias("name"))
    parts = [
        table_of.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), F.lit(table_exists(spark, f"{database}.load_{name}")).alias("found"), "row_count")
        for name in ("region", "nation")
        for table_of in [spark.table(f"{database}.load_{name}")]
    ]
    report = scratch_dir(spark, "report")
    write_report(spark, [row["name"] for row in listed.orderBy("name").collect()], report)
    lines = scan_lines(spark, report).where(F.col("value").startswith("load_"))
    parts.append(lines.agg(F.count("*").alias("row_count")).select(F.lit("report").alias("table_name"), (F.col("row_count") > 0).alias("found"), "row_count"))
    missing = table_exists(spark, f"{database}.load_customer")
    parts.append(spark.range(1).select(F.lit("customer").alias("table_name"), F.lit(missing).alias("found"), F.lit(None).cast("bigint").alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


@registered("SELECT count(*) AS row_count FROM events")
def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = fresh_sink(spark, "count")
    sink.replace(inputs.dated_events(spark, sf_dir))
    return row_count(scan_table(spark, sink.table))


@registered(TYPED_EVENT_SQL)
def append_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week after week: create, then append."""
    base, weeks = event_weeks(spark, sf_dir)
    sink = fresh_sink(spark, "append")
    target = target_from_text(spark, EVENT_FEED_DDL)
    return plain(load_periods(spark, as_periods(base, weeks), target, sink, mode="append"))


@registered(TYPED_EVENT_SQL)
def replace_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every week once, then the first and the last again: no row twice."""
    base, weeks = event_weeks(spark, sf_dir)
    sink = fresh_sink(spark, "period")
    target = target_from_text(spark, EVENT_FEED_DDL)
    periods = as_periods(base, weeks)
    load_periods(spark, periods, target, sink)
    return plain(load_periods(spark, [periods[0], periods[-1]], target, sink))


class CutOff(TableSink):
    """A sink whose driver dies after the first batch is written and before the stream notes it."""

    def replace_batch(self, df: DataFrame, batch: str) -> None:
        super().replace_batch(df, batch)
        raise RuntimeError("cut off")


def arrive_in_lots(spark: SparkSession, feed: DataFrame, sink: TableSink, lots: list[DataFrame]) -> DataFrame:
    """Load lots of files one after the other; the first attempt at each is cut off after its write."""
    source, checkpoint = scratch_dir(spark, "arrivals"), scratch_dir(spark, "ingest_checkpoint")
    target = target_from_text(spark, EVENT_FEED_DDL)
    dying = CutOff(sink.table, sink.location)
    for n, lot in enumerate(lots):
        rebalance(lot, "PartitionDate").write.parquet(f"{source}/lot{n}")
        try:
            ingest_new_files(spark, source, target, dying, checkpoint)
        except StreamingQueryException:
            pass
        taken = ingest_new_files(spark, source, target, sink, checkpoint)
    return taken


def halves(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The earlier and the later weeks of the feed."""
    weeks = inputs.weeks_of(feed, "PartitionDate")
    half = F.lit(weeks[len(weeks) // 2])
    return feed.where(F.col("PartitionDate") < half), feed.where(F.col("PartitionDate") >= half)


@registered(TYPED_EVENT_SQL)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks in two lots into the table; each batch is cut off once between its write and its commit."""
    feed = inputs.event_feed(spark, sf_dir)
    return plain(arrive_in_lots(spark, feed, fresh_sink(spark, "ingested"), list(halves(feed))))


@registered(f"""
WITH half AS (SELECT min(m) + INTERVAL 7 DAY * ((date_diff('day', min(m), max(m)) // 7 + 1) // 2) AS day
  FROM (SELECT date_trunc('week', partitiondate) AS m FROM ({TYPED_EVENT_SQL})))
SELECT f.* EXCLUDE (eventtype), CASE WHEN partitiondate >= half.day THEN eventtype END AS eventtype,
  CASE WHEN partitiondate >= half.day THEN CAST(value AS DOUBLE) * 2 END AS twice FROM ({TYPED_EVENT_SQL}) f, half""")
def incremental_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second lot brings two columns that the first lacks; they are null in the rows before."""
    feed = inputs.event_feed(spark, sf_dir)
    early, late = halves(feed)
    lots = [early.drop("EventType"), late.withColumn("Twice", F.col("Value").cast("decimal(12,2)").cast("double") * 2)]
    return plain(arrive_in_lots(spark, feed, fresh_sink(spark, "drifted"), lots))


# -- feeds, logs and checks ----------------------------------------------------


@registered("""
SELECT i AS record_id, 'ok' AS status, 'acct-' || i AS accountid,
       DATE '2025-09-01' + CAST(i % 30 AS INTEGER) AS partitiondate,
       i * 0.01::DOUBLE AS costcurrencyvendorusd_adjustedamortizedcost,
       i * 0.02::DOUBLE AS costcurrencyvendorusd_cost,
       'USD' AS costcurrencyvendorusd_currencycode,
       i * 0.03::DOUBLE AS costcurrencyvendorraw_adjustedamortizedcost,
       i * 0.04::DOUBLE AS costcurrencyvendorraw_cost,
       'USD' AS costcurrencyvendorraw_currencycode
FROM (SELECT o_orderkey AS i FROM orders)""")
def generated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated row for each order, by its key, flattened."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("record_id"))
    return flatten_append(feed_of(keys))


@registered("""
WITH n AS (SELECT count(*) AS row_count FROM lineitem)
SELECT seq, step, row_count, column_count FROM n, (VALUES
  (0, 'raw', 10), (1, 'lowercase', 10), (2, 'flatten', 14), (3, 'conform', 14), (4, 'written', 14)
) AS v(seq, step, column_count)""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns after each stage, from the marker table; all counted in the pass that writes."""
    log = RunLog(spark, scratch_dir(spark, "runlog"))
    target = target_from_text(spark, COST_FEED_DDL)
    raw = log.watched("raw", inputs.cost_feed(spark, sf_dir))
    lower = log.watched("lowercase", lowercase_nested(raw))
    flat = log.watched("flatten", flatten_append(lower))
    typed = log.watched("conform", conform(flat, target))
    sink = fresh_sink(spark, "summary")
    with log.timed("write"):
        sink.replace(typed)
    counts = log.mark_watched()
    written = scan_table(spark, sink.table)
    rows = written.count()  # from footers
    log.mark("written", sink.table, rows, len(written.columns))
    log.summarize("run_summary", sink.table, sf_dir, counts["raw"], rows, len(written.columns))
    return log.markers().select("seq", "step", "row_count", "column_count")


@registered(" UNION ALL ".join(
    f"SELECT '{name}' AS input, count(*) AS row_count, count(*) - count({key}) AS null_keys, "
    f"count(*) > 0 AND count(*) = count({key}) AS ok FROM {name}"
    for name, key in TABLE_KEYS.items()
))
def input_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {name: (f"{sf_dir}/{name}.parquet", key) for name, key in TABLE_KEYS.items()}
    return health_check(spark, given).drop("problem")


CHECKED_DDL = """CREATE TABLE LANDING.CHECKED (
  "EventId" BIGINT, "PartitionDate" DATE, "Stamp" TIMESTAMP_NTZ, "Code" BIGINT, "Value" NUMBER(4,2),
  "Props" DOUBLE, "Vendor" VARCHAR, "Shape" GEOGRAPHY, "UserId" VARCHAR);"""


def faulty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with texts that are no numbers, numbers too large, and epochs out of range."""
    code = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).when(F.col("event_id") % 3 == 1, F.col("user_id").cast("string"))
    stamp = F.when(F.col("event_id") % 10 == 0, F.lit(5)).otherwise(inputs.epoch_of("ts", "(event_id % 4)"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("EventId"),
        F.col("ts").cast("date").alias("PartitionDate"),
        stamp.alias("Stamp"),
        code.alias("Code"),
        F.col("value").alias("Value"),
        F.when(F.col("event_id") % 2 == 0, F.col("props")).alias("Props"),
        F.col("user_id").alias("UserId"),
        F.col("event_type").alias("EventType"),
    )


FAULTY_SQL = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1 THEN CAST(user_id AS VARCHAR) END AS code,
  CASE WHEN event_id % 2 = 0 THEN props END AS props, value, user_id, event_type FROM events"""


@registered(f"""
WITH feed AS ({FAULTY_SQL}), n AS (SELECT count(*) AS rows, count(code) AS code, count(props) AS props, count(value) AS value,
  count(code) - count(TRY_CAST(code AS BIGINT)) AS bad_code, count(props) - count(TRY_CAST(props AS DOUBLE)) AS bad_props,
  count(value) - count(TRY_CAST(value AS DECIMAL(4,2))) AS bad_value, count(*) FILTER (WHERE event_id % 10 = 0) AS bad_stamp FROM feed)
SELECT v.name, v.source_type, v.target_type, v.status, v.recognized, CASE WHEN status <> 'missing' THEN rows END AS row_count,
  CASE v.name WHEN 'code' THEN code WHEN 'props' THEN props WHEN 'value' THEN value WHEN 'vendor' THEN NULL WHEN 'shape' THEN NULL ELSE rows END AS filled,
  CASE v.name WHEN 'code' THEN bad_code WHEN 'props' THEN bad_props WHEN 'value' THEN bad_value WHEN 'stamp' THEN bad_stamp
    WHEN 'vendor' THEN NULL WHEN 'shape' THEN NULL ELSE 0 END AS rejected
FROM n, (VALUES ('eventid', 'bigint', 'bigint', 'same', true), ('partitiondate', 'date', 'date', 'same', true),
  ('stamp', 'bigint', 'timestamp_ntz', 'epoch', true), ('code', 'string', 'bigint', 'cast', true),
  ('value', 'double', 'decimal(4,2)', 'cast', true), ('props', 'string', 'double', 'cast', true),
  ('vendor', NULL, 'string', 'missing', true), ('shape', NULL, 'string', 'missing', false),
  ('userid', 'bigint', 'string', 'cast', true), ('eventtype', 'string', NULL, 'extra', NULL)) AS v(name, source_type, target_type, status, recognized)""")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load did to each column: missing, extra, of unknown type, and values that do not fit; one pass."""
    return load_checked(spark, faulty_feed(spark, sf_dir), target_from_text(spark, CHECKED_DDL), fresh_sink(spark, "checked"), on_drift="fill")


@registered(f"""
WITH feed AS ({FAULTY_SQL}), judged AS (SELECT event_id, array_to_string([r for r in [
    CASE WHEN event_id % 10 = 0 THEN 'stamp: bigint does not fit timestamp_ntz' END,
    CASE WHEN code IS NOT NULL AND TRY_CAST(code AS BIGINT) IS NULL THEN 'code: string does not fit bigint' END,
    CASE WHEN value IS NOT NULL AND TRY_CAST(value AS DECIMAL(4,2)) IS NULL THEN 'value: double does not fit decimal(4,2)' END,
    CASE WHEN props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL THEN 'props: string does not fit double' END] if r IS NOT NULL], '; ') AS reasons FROM feed)
SELECT event_id, reasons <> '' AS rejected, CASE WHEN reasons <> '' THEN reasons END AS reasons FROM judged""")
def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the feed once: in the table, or in the quarantine with all its reasons; one pass, one write."""
    target = target_from_text(spark, CHECKED_DDL)
    good, bad = load_quarantined(spark, faulty_feed(spark, sf_dir), target, fresh_sink(spark, "good"), fresh_sink(spark, "bad"))
    kept = good.select(F.col("eventid").alias("event_id"), F.lit(False).alias("rejected"), F.lit(None).cast("string").alias("reasons"))
    aside = bad.select(F.get_json_object("raw", "$.eventid").cast("bigint").alias("event_id"), F.lit(True).alias("rejected"), F.array_join("reasons", "; ").alias("reasons"))
    return kept.unionByName(aside)


@registered(f"SELECT *, CAST(1 AS BIGINT) AS reads FROM ({TYPED_COST_SQL})")
def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that dies in its last stage and is run again: the source is opened once, the first stages run once."""
    source, folder = scratch_dir(spark, "resumed_source"), scratch_dir(spark, "resumed")
    overwrite_parquet(inputs.cost_feed(spark, sf_dir), source)
    target = target_from_text(spark, COST_FEED_DDL)
    log = RunLog(spark, scratch_dir(spark, "resumed_log"))
    attempts = {"read": 0, "last": 0}

    def read(path: str) -> DataFrame:
        attempts["read"] += 1
        return scan_recursive(spark, path)

    def last(df: DataFrame) -> DataFrame:
        attempts["last"] += 1
        if attempts["last"] == 1:
            raise RuntimeError("cut off")
        return conform(df, target)

    stages = [("flatten", flattened), ("conform", last)]
    for _ in range(2):
        try:
            done = run_stages(spark, source, read, stages, folder, COST_FEED_DDL, log)
        except RuntimeError:
            pass
    return plain(done).withColumn("reads", F.lit(attempts["read"]).cast("bigint"))


@registered("""
SELECT 'lot' || o_orderkey % 3 AS lot, count(*) AS n_rows, count(*) AS rows_read, true AS ok, false AS named FROM orders GROUP BY 1
UNION ALL SELECT 'lot3', NULL, NULL, false, true""")
def damaged_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files and the first half of a fourth: that one is named, the others are counted."""
    path = scratch_dir(spark, "damaged")
    orders = table(spark, sf_dir, "orders")
    for n in range(3):
        orders.where(F.col("o_orderkey") % 3 == n).coalesce(1).write.parquet(f"{path}/lot{n}")
    whole = file_attributes(spark, f"{path}/lot0").first()["path"]
    inputs.cut_off_copy(spark, whole, f"{path}/lot3/half.parquet")
    health = file_health(spark, path, deep=True)
    return health.select(F.regexp_extract("path", "lot[0-9]", 0).alias("lot"), "n_rows", "rows_read", "ok", F.col("problem").isNotNull().alias("named"))


# -- the whole load ------------------------------------------------------------


@registered(TYPED_COST_SQL)
def standardized_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transforms of the load without its write."""
    target = target_from_text(spark, COST_FEED_DDL)
    return plain(standardize(inputs.cost_feed(spark, sf_dir), target))


@registered(TYPED_COST_SQL)
def replace_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested files to a typed, partitioned table, read back."""
    source = scratch_dir(spark, "cost_feed")
    overwrite_parquet(inputs.cost_feed(spark, sf_dir), source, codec="snappy")
    target = target_from_text(spark, COST_FEED_DDL)
    log = RunLog(spark, scratch_dir(spark, "chain_log"))
    return plain(load_replace(spark, source, target, fresh_sink(spark, "chain"), log))


@registered(TYPED_COST_SQL)
def sql_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load as SQL over temp views."""
    source = scratch_dir(spark, "cost_feed_sql")
    overwrite_parquet(inputs.cost_feed(spark, sf_dir), source, codec="snappy")
    target = target_from_text(spark, COST_FEED_DDL)
    return plain(load_replace_sql(spark, source, target, fresh_sink(spark, "chain_sql")))
