"""Lines that many documents share: found by hash, dropped by position."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import SPACES, map_batches, text_of, written

MIN_CHARS = 40
MIN_DOCUMENTS = 5

_SPACES = SPACES.encode()


def keyed_lines(text: str, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text as bytes, and the digest of each key that is long enough.

    The key is the line without outer white space and with A-Z in lower case.
    """
    lines = text.encode("utf-8").split(b"\n")
    digests: list[bytes | None] = []
    for line in lines:
        key = line.strip(_SPACES)
        long_enough = len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8")) >= min_chars)
        digests.append(xxhash.xxh3_128_digest(key.lower()) if long_enough else None)
    return lines, digests


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = {d for d in keyed_lines(text, min_chars)[1] if d}
                ids += [doc_id] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    return run


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key): each 128-bit line digest once per row of `docs`."""
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return map_batches(narrow, _keys(min_chars), "doc_id long, key binary")


def shared_keys(keys: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(key, keeper): digests of at least `min_documents` documents, and the largest of their ids.

    Counted in two steps, by (key, document) and then by key from partial sums,
    so a line of every third document is no hot spot.
    """
    return (
        keys.groupBy("key", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("key")
        .agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
        .where(F.col("documents") >= min_documents)
        .select("key", "keeper")
    )


def _reassemble(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, drops = batch.columns
            kept, before, dropped = [], [], []
            for text, drop in zip(texts.to_pylist(), drops.to_pylist(), strict=True):
                if not drop:
                    kept.append(text)
                    before.append(text.count("\n") + 1)
                    dropped.append(0)
                    continue
                lines, digests = keyed_lines(text, min_chars)
                gone = set(drop)
                stay = [line for line, d in zip(lines, digests, strict=True) if d not in gone]
                kept.append(b"\n".join(stay).decode("utf-8"))
                before.append(len(lines))
                dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                ["row", "kept_text", "n_lines", "n_dropped"],
            )

    return run


def drop_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped) for each row of `docs` (doc_id, text).

    `row` is the whole input row as a struct, so no column name can clash. A
    text is split at \\n. The key of a line is the line without outer
    `[\\x20\\x09-\\x0D]` and with A-Z in lower case. Keys of at least `min_chars`
    code points in at least `min_documents` documents lose all their lines,
    except in the largest doc_id that has them; the rest stays, joined by \\n.

    A null or empty text is one empty line, and comes back empty. Rows with the
    same doc_id count as one document, and rows without one as one document that
    is smaller than all others. A text whose lines all go is empty. An empty
    table gives an empty one.
    """
    keys = written(line_keys(docs, min_chars), "line_keys")
    shared = written(shared_keys(keys, min_documents), "shared_keys")
    # One row per key on the right; adaptive execution splits the rows of a hot key on the left.
    drops = (
        keys.join(shared, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("drop_id"))
        .agg(F.collect_set("key").alias("drop"))
    )
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    rows = docs.select(whole, docs["doc_id"].cast("long").alias("id"), text_of(docs).alias("text"))
    joined = rows.join(drops, rows["id"].eqNullSafe(drops["drop_id"]), "left").select("row", "text", "drop")
    kind = joined.schema["row"].dataType.simpleString()
    schema = f"row {kind}, kept_text string, n_lines long, n_dropped long"
    return map_batches(joined, _reassemble(min_chars), schema)
