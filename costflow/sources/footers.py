"""What the footers of Parquet files say: rows, layout, damage. Read in tasks, one footer at a time."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote as percent
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.sources.files import file_attributes

FOOTER_SCHEMA = "path string, length bigint, modified timestamp, n_rows bigint, layout string, problem string"

#: Footers that one task reads.
FILES_PER_TASK = 64


def _opened(path: str):
    """(file system, name) for a path as Spark lists it."""
    from pyarrow import fs

    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("//", "/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
    return fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{percent(parts.path)}")


def _read(path: str) -> tuple[int | None, str | None, str | None]:
    from pyarrow import parquet

    try:
        files, name = _opened(path)
        with files.open_input_file(name) as file:
            meta = parquet.ParquetFile(file).metadata
            return meta.num_rows, str(meta.schema.to_arrow_schema().remove_metadata()), None
    except (OSError, pa.ArrowException) as error:
        return None, None, str(error).splitlines()[0]


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_rows, layout, problem = zip(*map(_read, batch.column("path").to_pylist()), strict=True) if batch.num_rows else ((), (), ())
        more = [pa.array(list(n_rows), pa.int64()), pa.array(list(layout), pa.string()), pa.array(list(problem), pa.string())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], ["path", "length", "modified", "n_rows", "layout", "problem"])


def file_footers(spark: SparkSession, *paths: str, suffix: str = ".parquet") -> DataFrame:
    """(path, length, modified, n_rows, layout, problem) of every file whose name ends in `suffix`.

    `layout` tells the columns and types of a file; equal texts mean equal ones. A
    file whose footer cannot be read has a `problem` and nulls instead. Paths that
    are not there give no rows. Only footers are read, by pyarrow, which must know
    the file system.
    """
    try:
        files = file_attributes(spark, *paths, suffix=suffix)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FOOTER_SCHEMA)
    for path in paths:
        _opened(path)  # a file system that pyarrow does not know fails here, and is no damage
    # A task of Spark's listing holds as many files as their bytes allow, which says nothing here.
    dealt = files.repartition(max(1, -(-files.count() // FILES_PER_TASK)))
    return dealt.mapInArrow(_footers, FOOTER_SCHEMA)
