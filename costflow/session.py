"""Session defaults for the load jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # A bad value fails the job instead of turning into a silent null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Fewer, larger scan tasks. Under 2000 shuffle partitions the sizes of all
    # map outputs stay exact, which the splitting of hot dates relies on.
    "spark.sql.files.maxPartitionBytes": "256m",
    # The caller's to set: about shuffled bytes / 256 MB, and at most 1999. More
    # is left to the adaptive split of large partitions.
    "spark.sql.shuffle.partitions": "1000",
    # Shuffle bytes per write task. Row-wise shuffle data shrinks to roughly a
    # half as zstd Parquet, so this lands near 128 MB files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with the defaults above; `overrides` use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    conf = DEFAULTS | {key.replace("__", "."): value for key, value in overrides.items()}
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
