"""Parquet and table scans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.operators.widen import merged, widened_items
from costflow.sources.footers import file_footers
from costflow.sqltext import project


def scan_folder(spark: SparkSession, path: str) -> DataFrame:
    """One folder; `column=value` folders below it become partition columns."""
    return spark.read.parquet(path)


def scan_recursive(
    spark: SparkSession, *paths: str, glob: str = "*.parquet", merge: bool = True
) -> DataFrame:
    """All matching files below the paths, at any depth.

    Spark does no partition discovery here: `column=value` folders are just
    folders. The glob is case sensitive. Brace paths such as `base/{a,b}` work.
    With `merge` the columns of all files are united, rows of files without one
    getting null, and files that disagree on a type are refused at once; that
    reads every footer, in a Spark job. Without it, one file stands for all.
    """
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("mergeSchema", str(merge).lower())
        .option("pathGlobFilter", glob)
        .parquet(*paths)
    )


def scan_periods(
    spark: SparkSession, base: str, periods: Sequence[str], folder: str = "{}"
) -> DataFrame:
    """The folders of several periods as one scan.

    `folder` is the folder name with `{}` for the period, such as `period={}`.
    """
    if not periods:
        raise ValueError("no periods given")
    return scan_recursive(spark, *(f"{base.rstrip('/')}/{folder.format(p)}" for p in periods))


def scan_widened(spark: SparkSession, *paths: str, suffix: str = ".parquet") -> DataFrame:
    """All matching files below the paths, also where they disagree on types.

    The footers are read in Spark tasks and the files grouped by their columns and
    types; every group is a scan of its own, cast to the narrowest types that take
    all (`operators.widen.widest`) and united. Types that none covers are refused
    by the column's name. The lists of paths, of the size of Spark's own listing,
    and one schema a group are all that reaches the driver. A file whose footer
    cannot be read fails the scan, as does a scan without files.
    """
    footers = file_footers(spark, *paths, suffix=suffix)
    groups = footers.groupBy("layout", "problem").agg(F.sort_array(F.collect_list("path")).alias("files"), F.min("path").alias("first"))
    found = groups.orderBy("first").collect()
    bad = [f"{row['first']}: {row.problem}" for row in found if row.problem]
    if bad or not found:
        raise ValueError(f"files that cannot be read: {bad}" if bad else f"no files below {paths}")
    # One footer stands for a group, whose files have the same columns and types.
    scans = [spark.read.option("mergeSchema", "false").parquet(*row.files) for row in found]
    wide = merged([scan.schema for scan in scans])
    return reduce(DataFrame.unionByName, [project(scan, widened_items(scan.schema, wide)) for scan in scans])


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def row_count(df: DataFrame) -> DataFrame:
    """One row `row_count`. Over plain Parquet this reads footers only."""
    return df.agg(F.count("*").alias("row_count"))


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the path, size and modification time of the file each row came from."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )
