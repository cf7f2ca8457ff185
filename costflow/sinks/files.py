"""Plain file outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_parquet(df: DataFrame, path: str, *partition_by: str, codec: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", codec).partitionBy(*partition_by).parquet(path)


def write_text(df: DataFrame, path: str, line_sep: str = "\n") -> None:
    """A one-column text frame, in parallel."""
    df.write.option("lineSep", line_sep).text(path)


def write_report(spark: SparkSession, lines: Sequence[str], path: str) -> None:
    """A short list of lines held by the driver, as one text file in order."""
    numbered = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    numbered.coalesce(1).sortWithinPartitions("n").select("value").write.text(path)


def preview(df: DataFrame, rows: int, *order_by: str) -> DataFrame:
    """The first rows in a total order, or any rows if no order is given."""
    if order_by:
        df = df.orderBy(*(F.col(c) for c in order_by))
    return df.limit(rows)


def describe(df: DataFrame, rows: int = 5) -> None:
    """Print schema and a few rows. Call it on a written table, not on a long plan."""
    df.printSchema()
    df.show(rows, truncate=False)
