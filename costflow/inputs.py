"""Feeds that the registered queries derive from the given tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.operators.distribute import rebalance

# The key of every given table; none of them may hold nulls.
TABLE_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}

# The column names of the cost feed and the types of their families; the table's name is made up.
COST_FEED_DDL = """create or replace TABLE LANDING.COST_FEED cluster by ("UsageStartTime")(
	"CostCurrencyVendorUSD_AdjustedAmortizedCost" FLOAT,
	"CostCurrencyVendorUSD_Cost" FLOAT,
	"CostCurrencyVendorUSD_CurrencyCode" VARCHAR(16777216),
	"CostCurrencyVendorRaw_AdjustedAmortizedCost" FLOAT,
	"CostCurrencyVendorRaw_Cost" FLOAT,
	"CostCurrencyVendorRaw_CurrencyCode" VARCHAR(16777216),
	"PartitionDate" DATE,
	"UsageStartTime" TIMESTAMP_NTZ(9),
	"UsageEndTime" TIMESTAMP_NTZ(9),
	"Month" NUMBER(38,0),
	"MspExposeToEndCustomers" BOOLEAN,
	"Vendor" VARCHAR(16777216),
	ID VARCHAR(16777216),
	PRIMARY KEY (ID)
);
"""

EVENT_FEED_DDL = """create or replace TABLE LANDING.EVENT_FEED (
	"EventId" VARCHAR(40),
	"PartitionDate" DATE,
	"UsageStartTime" TIMESTAMP_NTZ(9),
	"UsageEndTime" TIMESTAMP_NTZ(9),
	"UserId" NUMBER(38,0),
	"Value" NUMBER(12,2),
	"Flag" BOOLEAN,
	"Vendor" VARCHAR(16777216)
);
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_of(stamp: str, unit: str) -> F.Column:
    """The zone-less timestamp `stamp` as integer epoch in s, ms, us or ns by `unit` 0 to 3."""
    micros = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {stamp})"
    return F.expr(
        f"CASE {unit} WHEN 0 THEN {micros} div 1000000L WHEN 1 THEN {micros} div 1000L "
        f"WHEN 2 THEN {micros} ELSE {micros} * 1000L END"
    )


def cost_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as a mixed-case nested cost feed with one partition date per month."""
    price = F.col("l_extendedprice")

    def costs(adjusted, currency: str):
        return F.struct(
            adjusted.alias("AdjustedAmortizedCost"),
            price.alias("Cost"),
            F.lit(currency).alias("CurrencyCode"),
        )

    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("RecordId"),
        F.concat(F.lit("acct-"), F.col("l_suppkey").cast("string")).alias("AccountId"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("PartitionDate"),
        costs(price * (1 - F.col("l_discount")), "USD").alias("CostCurrencyVendorUSD"),
        # Untaxed lines have no raw cost at all: the struct itself is null.
        F.when(F.col("l_tax") > 0, costs(price * (1 + F.col("l_tax")), "EUR")).alias(
            "CostCurrencyVendorRaw"
        ),
        epoch_of("l_shipdate", "(l_linenumber % 4)").alias("UsageStartTime"),
        F.date_add(F.col("l_shipdate").cast("date"), 1).cast("string").alias("UsageEndTime"),
        F.month("l_shipdate").alias("Month"),
        (F.col("l_linenumber") % 2).alias("MspExposeToEndCustomers"),
        F.col("l_partkey").alias("Id"),
    )


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a flat feed with epochs of mixed unit, as numbers and as text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("EventId"),
        F.col("ts").cast("date").alias("PartitionDate"),
        epoch_of("ts", "(event_id % 4)").alias("UsageStartTime"),
        F.when(F.col("event_id") % 2 == 0, epoch_of("ts", "1").cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("UsageEndTime"),
        F.col("user_id").alias("UserId"),
        F.col("value").alias("Value"),
        (F.col("event_id") % 2).cast("int").alias("Flag"),
        F.col("event_type").alias("EventType"),
    )


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("partitiondate"), "user_id", "event_type", "value", "props"
    )


def weeks_of(df: DataFrame, column: str) -> list[date]:
    """The Mondays of the weeks from the first to the last date of a column."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    monday = low - timedelta(days=low.weekday())
    return [monday + timedelta(days=7 * n) for n in range((high - monday).days // 7 + 1)]


def write_by_week(df: DataFrame, column: str, path: str) -> None:
    """One folder `week=<Monday>` per week of the date column."""
    week = F.date_trunc("week", F.col(column)).cast("date")
    rebalance(df.withColumn("week", week), "week").write.partitionBy("week").parquet(path)


def cut_off_copy(spark: SparkSession, source: str, copy: str, share: float = 0.5) -> None:
    """The first part of a file under another name, as a writer that died leaves it."""
    hadoop = spark._jvm.org.apache.hadoop
    old, new = hadoop.fs.Path(source), hadoop.fs.Path(copy)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    part = int(files.getFileStatus(old).getLen() * share)
    given, taken = files.open(old), files.create(new, True)
    spark._jvm.org.apache.commons.io.IOUtils.copyLarge(given, taken, 0, part)
    given.close()
    taken.close()


def part_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CREATE TABLE text per row of `part`, its names and types made from the row."""
    texts = F.format_string(
        'create or replace TABLE SHOP.PART_%d cluster by (to_date("Size"))(\n'
        '\t"%s, (net)" NUMBER(%d,0),\n'
        "\tBRAND VARCHAR(%d) COMMENT 'a, b (c)',\n"
        '\t"Price" NUMBER(38, %d) NOT NULL, -- two on a line\n'
        '\t"Price Class" DECIMAL, "Sold" BOOLEAN,\n'
        "\tPRIMARY KEY (BRAND)\n)",
        "p_partkey",
        "p_name",
        F.col("p_size") % 38 + 1,
        F.col("p_size"),
        F.col("p_size") % 10,
    )
    return table(spark, sf_dir, "part").select(texts.alias("value"))
