"""Row placement before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rebalance(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """Bring equal keys together, but split a key that is too big for one task.

    A plain hash repartition would send a date that holds a third of all rows
    to a single task. The rebalance hint shuffles on the same hash and lets
    adaptive execution cut large partitions by map output, which also works
    where rows are exact copies and no hash of the row could tell them apart.
    """
    count = () if partitions is None else (partitions,)
    return df.hint("rebalance", *count, *columns)


def distribute_sorted(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """`rebalance`, then a sort inside each task, so a task writes one file at a time."""
    return rebalance(df, *columns, partitions=partitions).sortWithinPartitions(*columns)


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even out the rows over a number of partitions (files), regardless of content."""
    return df.repartition(partitions)


def partition_sizes(df: DataFrame) -> DataFrame:
    """(partition, row_count) of every non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("row_count"))
