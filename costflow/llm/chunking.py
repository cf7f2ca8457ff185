"""Document fingerprints: content-defined chunks and length-weighted containment."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import map_batches, text_of

#: Chunk sizes in bytes. Small, so that short texts still have several chunks.
MIN_SIZE, NORMAL_SIZE, MAX_SIZE = 8, 32, 128
#: Hash bits that must be zero at a boundary: more before the normal size, fewer after it.
STRICT = np.uint32(0b111111 << 26)
LOOSE = np.uint32(0b1111 << 28)
#: A random number per byte value, from a fixed seed.
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)
DIGEST_BITS = 40
#: Buckets of neighbouring ids per shuffle partition, so that hashing them stays even.
BUCKETS_PER_PARTITION = 4
#: Bounds that one step of the search for a bucket looks at.
FAN = 64


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling gear hash after every byte; a byte leaves the 32 bits after 32 steps.

    The sum over the last 32 bytes is built by doubling, so no step runs per byte.
    """
    h = GEAR[data]
    width = 1
    while width < 32:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of a text, the last being its length."""
    n = len(data)
    h = gear_hashes(np.frombuffer(data, np.uint8)) if n else np.zeros(0, np.uint32)
    at = np.flatnonzero((h & LOOSE) == 0)
    strict = (h[at] & STRICT) == 0
    cuts, start = [], 0
    for p, hard in zip((at + 1).tolist(), strict.tolist(), strict=True):
        size = p - start
        while size > MAX_SIZE:
            start += MAX_SIZE
            cuts.append(start)
            size = p - start
        if size >= NORMAL_SIZE or (hard and size >= MIN_SIZE):
            cuts.append(p)
            start = p
    while n - start > MAX_SIZE:
        start += MAX_SIZE
        cuts.append(start)
    if n > start:
        cuts.append(n)
    return cuts


def chunk_set(text: str) -> dict[int, int]:
    """Digest to length in bytes of each distinct chunk."""
    data, start, chunks = text.encode("utf-8"), 0, {}
    hashed, shift = xxhash.xxh64_intdigest, 64 - DIGEST_BITS
    for end in boundaries(data):
        chunks[hashed(data[start:end]) >> shift] = end - start
        start = end
    return chunks


def encoded(chunks: dict[int, int]) -> str:
    """A chunk set as text: base 64 of sorted (40-bit digest, 8-bit length)."""
    cells = np.sort(np.fromiter((d << 8 | n for d, n in chunks.items()), np.uint64, len(chunks)))
    return base64.b64encode(cells.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decoded(fingerprint: str) -> dict[int, int]:
    raw = base64.b64decode(fingerprint)
    cells = (int.from_bytes(raw[i : i + 6], "big") for i in range(0, len(raw), 6))
    return {c >> 8: c & 255 for c in cells}


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """Share of the bytes of `own`'s chunks that `other` has too; two empty sets are alike."""
    if not own:
        return 0.0 if other else 1.0
    return sum(n for d, n in own.items() if d in other) / sum(own.values())


# -- every document and the next -----------------------------------------------


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of `following`, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pair_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    waiting = None  # a document whose next one is yet to come
    for batch in batches:
        rows = []
        for doc_id, text, guard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            chunks = chunk_set(text)
            if waiting is not None:
                own_id, own, own_chunks = waiting
                edited = edited_text(own, text)
                edited_chunks = chunk_set(edited)
                rows.append((
                    own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), encoded(own_chunks), encoded(edited_chunks),
                    containment(own_chunks, edited_chunks), containment(own_chunks, chunks),
                ))
            waiting = None if guard else (doc_id, text, chunks)
        if rows:
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _in_buckets(rows: DataFrame, bounds: list[int]) -> DataFrame:
    """`rows` with `bucket`: how many of the sorted bounds are below the id; null counts as below all.

    A search tree of arrays: each step looks at FAN bounds of one level, which
    keeps the generated code small whatever the number of bounds.
    """
    levels = [bounds]
    while len(levels[0]) > FAN:
        levels.insert(0, levels[0][FAN - 1 :: FAN])
    rows = rows.withColumn("bucket", F.lit(0))
    for level in levels:
        if level:
            part = F.slice(F.array(*map(F.lit, level)), F.col("bucket") * FAN + 1, FAN)
            below = F.size(F.filter(part, lambda b: b < F.col("doc_id")))
            rows = rows.withColumn("bucket", F.col("bucket") * FAN + below)
    return rows


def _guards(rows: DataFrame) -> DataFrame:
    """The row that follows each bucket: the first of the next lower one, after the last that of the highest.

    Buckets number a few per shuffle partition; their largest ids and the order
    of the buckets are all that the driver sees.
    """
    tops = {r["bucket"]: r["top"] for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops)
    if not order:
        return rows.limit(0)
    before = [F.lit(x) for k, b in enumerate(order) for x in (b, order[(k + 1) % len(order)])]
    ids = [t for t in tops.values() if t is not None]
    first = F.col("doc_id").isin(ids) if ids else F.lit(False)
    if len(ids) < len(tops):
        first = first | F.col("doc_id").isNull()
    heads = rows.where(first).groupBy("bucket").agg(F.max(F.struct("doc_id", "text")).alias("head"))
    return heads.select("head.doc_id", "head.text", F.element_at(F.create_map(*before), F.col("bucket")).alias("bucket"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each row of `docs` (doc_id, text), with that of its edited text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next). The edited text ends in the beginning of the next
    document, by descending doc_id, after the last the first. Likeness is the
    share of a text's distinct chunk bytes that the other fingerprint holds; two
    empty texts are alike (1), an empty text is unlike any other (0).

    Null texts are empty. Null ids come last. Rows of one doc_id follow each
    other by descending text; their order is that of the whole table. A single
    row is its own next. Other columns are not read. An empty table gives an
    empty one.

    The one shuffle deals whole texts by ranges of ids; a guard row at the end of
    each range carries the first document of the next.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = narrow.agg(F.percentile_approx("doc_id", shares, 10 * buckets).alias("b")).first()["b"] or []
    rows = _in_buckets(narrow, sorted(set(bounds)))
    both = rows.withColumn("guard", F.lit(False)).unionByName(_guards(rows).withColumn("guard", F.lit(True)))
    order = [F.col("bucket"), F.col("guard"), F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    dealt = both.repartition("bucket").sortWithinPartitions(*order).select("doc_id", "text", "guard")
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return map_batches(dealt, _pair_task, schema)
