"""Fresh folders on storage that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below `spark.checkpoint.dir`, or else below the warehouse.

    Never a temporary folder of one machine: executors could not reach it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{base.rstrip('/')}/costflow/{label}-{uuid.uuid4().hex}"
