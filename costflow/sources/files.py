"""What files there are, without reading them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.functions.sizes import human_bytes


def file_attributes(spark: SparkSession, *paths: str, suffix: str = ".parquet") -> DataFrame:
    """(path, length, modified) of every file whose name ends in `suffix`, any case."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        # The content column is never asked for, so no file is opened.
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    return files.where(F.lower("path").endswith(suffix.lower()))


def file_inventory(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """One row (path, n_files, total_bytes, total_size); zeros if the path is not there."""
    try:
        files = file_attributes(spark, path, suffix=suffix)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length bigint")
    totals = files.agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
    )
    return totals.select(
        F.lit(path).alias("path"),
        "n_files",
        "total_bytes",
        human_bytes(F.col("total_bytes")).alias("total_size"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
