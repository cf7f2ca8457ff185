"""What the operators share: words, written tables, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.scratch import scratch_dir

#: The white space of all contracts here, as a set of characters.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder.

    Cuts the lineage: a lost executor costs no more than the tasks it ran.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package where driver and workers see the same folder.

    On a cluster without such a folder install the package on all machines, or
    hand it to spark-submit as a zip with --py-files.
    """
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """`mapInArrow` with the package within the workers' reach."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (one more: the end); no text is null."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_slices(batch: pa.RecordBatch, texts: str, most: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts have about `most` bytes, or one row of more."""
    if not batch.num_rows:
        return
    column = batch.column(texts)
    offsets = np.frombuffer(column.buffers()[1], np.int32, batch.num_rows + 1, column.offset * 4)
    at = 0
    while at < batch.num_rows:
        past = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        past = min(max(past, at + 1), batch.num_rows)
        yield batch.slice(at, past - at)
        at = past


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text as string, null as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def without(text: Column, chars: str) -> Column:
    """The text without these characters; byte searches are faster here than one pass by code point."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text that is not null."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def first_per(df: DataFrame, key: str) -> DataFrame:
    """One whole row per value of `key`, null being a value; the smallest by all other columns' text."""
    whole = F.struct(*(df[c] for c in df.columns))
    order = F.struct(F.xxhash64(*(df[c] for c in df.columns)).alias("mark"), whole.alias("row"))
    return df.groupBy(df[key].alias("_key")).agg(F.min_by(order["row"], order["mark"]).alias("row")).select("row.*")
