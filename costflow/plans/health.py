"""Check inputs before a load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.sinks.table import create_database
from costflow.sources.files import file_inventory
from costflow.sources.footers import file_footers
from costflow.sources.parquet import scan_recursive
from costflow.sqltext import quote
from costflow.sources.text import load_target

HEALTH_SCHEMA = "input string, row_count bigint, null_keys bigint, ok boolean, problem string"


def health_check(
    spark: SparkSession, inputs: Mapping[str, tuple[str, str]], isolate: bool = True
) -> DataFrame:
    """(input, row_count, null_keys, ok, problem) for `{input: (parquet path, key column)}`.

    An input that cannot be opened, or lacks its key, becomes a row with the
    reason instead of an exception. With `isolate` each input is counted in a job
    of its own that reads its key column only, so that a damaged file is reported
    the same way; without it all are counted in one job, which such a file fails.
    """
    parts = []
    for name, (path, key) in inputs.items():
        try:
            checked = _counted(spark.read.parquet(path), name, key)
            if isolate:
                checked = spark.createDataFrame(checked.collect(), HEALTH_SCHEMA)
        except (PySparkException, Py4JJavaError) as error:
            checked = spark.createDataFrame([(name, None, None, False, _reason(error))], HEALTH_SCHEMA)
        parts.append(checked)
    return reduce(DataFrame.unionByName, parts)


def file_health(spark: SparkSession, *paths: str, deep: bool = False, suffix: str = ".parquet") -> DataFrame:
    """(path, length, n_rows, rows_read, ok, problem) of every file below the paths: which one is damaged, and how.

    A file without a readable footer has a problem and no number of rows. With
    `deep`, the others are read in all columns, past damage, and a file that gives
    fewer rows than its footer says is damaged too; without it `rows_read` is null.
    Files that disagree on columns or types are read apart.
    """
    footers = file_footers(spark, *paths, suffix=suffix)
    if deep:
        # Footers are read once more for the second use, which is cheaper than keeping them.
        groups = footers.where("problem IS NULL AND n_rows > 0").groupBy("layout").agg(F.collect_list("path").alias("files")).collect()
        scans = [_rows_by_file(spark, row["files"]) for row in groups]
        read = reduce(DataFrame.unionByName, scans, spark.createDataFrame([], "_path string, rows_read bigint"))
        footers = footers.join(read, footers["path"] == read["_path"], "left").drop("_path")
        footers = footers.withColumn("rows_read", F.when(F.col("problem").isNull(), F.coalesce("rows_read", F.lit(0))))
    else:
        footers = footers.withColumn("rows_read", F.lit(None).cast("bigint"))
    lost = F.col("rows_read") < F.col("n_rows")
    problem = F.when(lost, F.format_string("only %d of %d rows can be read", "rows_read", "n_rows")).otherwise(F.col("problem"))
    return footers.select("path", "length", "n_rows", "rows_read", problem.isNull().alias("ok"), problem.alias("problem"))


def _rows_by_file(spark: SparkSession, files: list[str]) -> DataFrame:
    scan = spark.read.option("mergeSchema", "false").option("ignoreCorruptFiles", "true").parquet(*files)
    # A hash that the result depends on makes the scan read every column.
    whole = F.bit_xor(F.xxhash64(*(F.col(quote(c)) for c in scan.columns)))
    place = F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "file:/")
    read = scan.groupBy(place.alias("_path")).agg(F.count("*").alias("rows"), whole.alias("hash"))
    return read.select("_path", F.when(F.col("hash").isNotNull(), F.col("rows")).alias("rows_read"))


def preflight(
    spark: SparkSession, source: str, ddl: str, database: str, location: str | None = None
) -> DataFrame:
    """(check, ok, detail) for the four things a load needs; none of them raises."""
    checks = {
        "ddl_file": lambda: _present(file_inventory(spark, ddl, suffix="").first().total_bytes, "bytes"),
        "ddl_columns": lambda: _present(len(load_target(spark, ddl).columns), "columns"),
        "source": lambda: _present(len(scan_recursive(spark, source).columns), "columns"),
        "database": lambda: create_database(spark, database, location) or database,
    }
    results = []
    for name, check in checks.items():
        try:
            results.append((name, True, check()))
        except (PySparkException, Py4JJavaError, ValueError) as error:
            results.append((name, False, _reason(error)))
    return spark.createDataFrame(results, "check string, ok boolean, detail string")


def _counted(df: DataFrame, name: str, key: str) -> DataFrame:
    counts = df.agg(F.count("*").alias("row_count"), F.count_if(F.col(quote(key)).isNull()).alias("null_keys"))
    return counts.select(
        F.lit(name).alias("input"),
        "row_count",
        "null_keys",
        ((F.col("row_count") > 0) & (F.col("null_keys") == 0)).alias("ok"),
        F.lit(None).cast("string").alias("problem"),
    )


def _present(count: int, unit: str) -> str:
    if not count:
        raise ValueError(f"no {unit}")
    return f"{count} {unit}"


def _reason(error: Exception) -> str:
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return condition or str(error).strip().splitlines()[-1]
