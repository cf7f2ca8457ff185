"""Stages of a load whose results outlive the run: a second run begins where the first was cut off."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.sinks.runlog import RunLog
from costflow.sources.files import file_attributes
from costflow.sqltext import one_row

Stage = tuple[str, Callable[[DataFrame], DataFrame]]

STAGE_SCHEMA = "key string, stage string, output string, row_count bigint, finished_at timestamp"


def source_fingerprint(spark: SparkSession, *paths: str, suffix: str = ".parquet") -> str:
    """A text that changes with the path, length or time of any file; the order of the files does not matter."""
    files = file_attributes(spark, *paths, suffix=suffix)
    mark = F.xxhash64("path", "length", "modified")
    row = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.bit_xor(mark).alias("mark")).first()
    return f"{row.n}:{row.bytes}:{row.mark}"


def run_stages(
    spark: SparkSession,
    source: str,
    read: Callable[[str], DataFrame],
    stages: Sequence[Stage],
    folder: str,
    settings: str = "",
    log: RunLog | None = None,
) -> DataFrame:
    """Run `(name, function)` stages on `read(source)`, each result a Parquet table below `folder`; returns the last.

    A stage that is written whole leaves a marker row with its key: a digest of
    the source's files, of `settings` (whatever else decides the result, such as
    the DDL) and of the names of all stages so far. A run looks for the last stage
    with a marker of its own key, reads that stage's table and goes on from there;
    the source is opened only if there is none. Other files, settings or stages
    make other keys, so nothing old is taken for new. A stage that was cut off has
    no marker and is written again.
    """
    markers = f"{folder.rstrip('/')}/markers"
    keys, text = [], f"{source_fingerprint(spark, source)}|{settings}"
    for name, _ in stages:
        text = hashlib.sha256(f"{text}|{name}".encode()).hexdigest()
        keys.append(text)
    done = _finished(spark, markers, keys)
    last = max((i for i, key in enumerate(keys) if key in done), default=-1)
    if log and last >= 0:
        log.mark("resumed", stages[last][0])
    df = read(source) if last < 0 else spark.read.parquet(done[keys[last]])
    for i in range(last + 1, len(stages)):
        name, function = stages[i]
        output = f"{folder.rstrip('/')}/{i:02d}-{name}-{keys[i][:16]}"
        function(df).write.mode("overwrite").option("compression", "zstd").parquet(output)
        df = spark.read.parquet(output)
        rows = df.count()  # from footers
        one_row(
            spark, key=("string", keys[i]), stage=("string", name), output=("string", output), row_count=("bigint", rows)
        ).withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(markers)
        if log:
            log.mark(name, output, rows, len(df.columns))
    return df


def _finished(spark: SparkSession, markers: str, keys: Sequence[str]) -> dict[str, str]:
    """Outputs by key; a row for each stage of this load at most."""
    try:
        rows = spark.read.schema(STAGE_SCHEMA).parquet(markers).where(F.col("key").isin(list(keys)))
        return {row.key: row.output for row in rows.collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
