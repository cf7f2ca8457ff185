"""Synthetic cost feeds for trials and benchmarks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ANCHOR = date(2025, 9, 1)

# What a generated row holds, so that feeds agree: a status, an account by its number,
# one of 30 dates, and for each cost struct the factors of its two amounts and the currency.
DAYS = 30
STATUS, ACCOUNT, CURRENCY = "ok", "acct-", "USD"
USD_FACTORS, RAW_FACTORS = (0.01, 0.02), (0.03, 0.04)


def generate_feed(
    spark: SparkSession, rows: int, anchor: date = ANCHOR, partitions: int | None = None
) -> DataFrame:
    """Rows 0 to n-1 with an account, one of 30 dates and two cost structs.

    The anchor date is fixed so that two runs agree. `partitions` sets the
    number of files; the range is made in that many parts, no shuffle needed.
    """
    return feed_of(spark.range(0, rows, 1, partitions).withColumnRenamed("id", "record_id"), anchor)


def feed_of(ids: DataFrame, anchor: date = ANCHOR) -> DataFrame:
    """`generate_feed` for the whole numbers in `record_id`, whatever they come from."""
    i = F.col("record_id")

    def costs(adjusted: float, cost: float):
        return F.struct(
            (i * F.lit(adjusted)).alias("adjustedamortizedcost"),
            (i * F.lit(cost)).alias("cost"),
            F.lit(CURRENCY).alias("currencycode"),
        )

    return ids.withColumns(
        {
            "status": F.lit(STATUS),
            "accountid": F.concat(F.lit(ACCOUNT), i.cast("string")),
            "partitiondate": F.date_add(F.lit(anchor), (i % DAYS).cast("int")),
            "costcurrencyvendorusd": costs(*USD_FACTORS),
            "costcurrencyvendorraw": costs(*RAW_FACTORS),
        }
    )


def wide_ddl(
    texts: int = 373, floats: int = 124, numbers: int = 6, stamps: int = 2
) -> str:
    """A CREATE TABLE text of the width and type mix of a full cost table.

    The default is 507 columns: the counts above, one DATE and one BOOLEAN.
    """
    families = [
        ("Measure", floats, "FLOAT"),
        ("UsageTime", stamps, "TIMESTAMP_NTZ(9)"),
        ("CalendarPart", numbers, "NUMBER(38,0)"),
        ("Tag", texts, "VARCHAR(16777216)"),
    ]
    columns = [f'"{name}{n}" {kind}' for name, count, kind in families for n in range(1, count + 1)]
    columns += ['"PartitionDate" DATE', '"ExposeToEndCustomers" BOOLEAN']
    body = ",\n\t".join(columns)
    return f'create or replace TABLE LANDING.COST_WIDE cluster by ("UsageTime1")(\n\t{body}\n);\n'
