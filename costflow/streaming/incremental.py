"""Pick up new feed files with a file-source stream and load them into the table, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costflow.operators.catalog import TargetSchema
from costflow.plans.chain import standardize
from costflow.sinks.table import BATCH, TableSink
from costflow.sources.parquet import scan_widened

#: Files that one batch takes at most; their paths pass through the driver.
MAX_FILES = 10_000

# What a stream of file names looks like, whatever is in the files.
_NAMES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: TargetSchema | None,
    sink: TableSink,
    checkpoint: str,
    max_files_per_batch: int = MAX_FILES,
    **policies,
) -> DataFrame:
    """Load the standardized rows of all files not seen before into the table, then stop.

    The stream carries the names of new files only; its checkpoint makes each
    name count once. A batch reads its own files, so their columns and types are
    found anew each time: files of one batch may disagree (`scan_widened`), a
    column that the table lacks is added to it, and one of another type is refused
    by name, which ends the stream before the batch is written.

    The rows carry the batch in the partition column `load_batch`: a name of the
    stream and the batch's number. A batch that was cut off and comes again
    replaces its own rows (`TableSink.replace_batch`), and the table itself tells
    which dates which batch brought (`TableSink.batches`). Returns the table
    without that column.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema(_NAMES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(source)
        .select("path")  # no file is opened for its content
    )

    def load(batch: DataFrame, number: int) -> None:
        paths = [row.path for row in batch.collect()]
        if paths:
            # Read and written in the caller's session, whose view of the table is then up to date.
            stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            rows = standardize(scan_widened(spark, *paths), target, **policies)
            sink.replace_batch(rows, f"{stream}-{number:09d}")

    query = (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.table(sink.table).drop(BATCH)
