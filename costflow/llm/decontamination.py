"""Benchmark decontamination: suffix arrays over shards of the training texts, searched for every benchmark suffix.

A shard is a run of documents within one task. Its words become 64-bit codes,
with a zero behind each document, and its suffixes are sorted by prefix doubling.
The suffixes of all benchmark items are looked up by binary search, many at a
time. Each finds its longest verbatim match, and where that is long enough the
range of the array that begins with its first words: every place at once. No rows
move between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import buffer_of, byte_slices, map_batches, text_of, written

WINDOW = 10

#: Bytes of text in a shard; a longer document is a shard of its own.
SHARD_BYTES = 6 << 20
#: Bytes of benchmark texts that are sent to all tasks at once; a larger benchmark takes several passes.
BLOCK_BYTES = 16 << 20
#: Places that are looked at together.
PLACES = 1 << 20

# Fixed value of the contract: the bytes of words after A-Z became lower case; all others are 0 here.
_BYTES = np.zeros(256, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _BYTES[_first : _last + 1] = np.arange(_first, _last + 1)
_BYTES[0x41:0x5B] = _BYTES[0x61:0x7B]

#: Words are hashed in steps of eight bytes; those of more steps one by one.
STEP, STEPS = 8, 8
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(STEP + 1)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Words:
    """The words of many texts: their codes with a zero behind each text, and where each text's codes begin."""

    codes: np.ndarray
    begins: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.begins) - 1


def words_of_texts(texts: pa.Array) -> Words:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, as codes.

    Equal words have equal codes; two different ones share a code with a chance
    of about 2 ** -64.
    """
    data, begins = buffer_of(texts)
    low = np.concatenate([_BYTES[data], np.zeros(STEP, np.uint8)])
    inside = low[: len(data)] != 0
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts_at, ends_at = edge == 1, edge == -1
    # Where a text ends in a word and the next begins with one, the first ends and the second begins.
    border = begins[(begins > 0) & (begins < len(data))]
    border = border[inside[border]]
    starts_at[border] = True
    ends_at[border[inside[border - 1]]] = True
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at)
    size = ends - starts
    chunks = np.ndarray((len(data) + 1,), "<u8", low, 0, (1,))
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    left = np.flatnonzero(size <= STEP * STEPS)
    for k in range(STEPS):
        if not len(left):
            break
        rest = size[left] - STEP * k
        h[left] = _mixed(h[left] ^ (chunks[starts[left] + STEP * k] & _KEEP[np.minimum(rest, STEP)]))
        left = left[rest > STEP]
    for i in np.flatnonzero(size > STEP * STEPS).tolist():
        h[i] = xxhash.xxh64_intdigest(low[starts[i] : ends[i]].tobytes())
    h[h == 0] = 1
    first = np.searchsorted(starts, begins)
    place = np.arange(len(starts)) + np.repeat(np.arange(len(texts)), np.diff(first))
    codes = np.zeros(len(starts) + len(texts), np.uint64)
    codes[place] = h
    return Words(codes, first + np.arange(len(first)))


# -- the suffix array ----------------------------------------------------------


def _sorted_by(key: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, keys in order). Where key and place fit into 64 bits, they are sorted as one number."""
    bits = max(len(key) - 1, 1).bit_length()
    if largest.bit_length() + bits <= 64:
        both = np.sort(key << np.uint64(bits) | np.arange(len(key), dtype=np.uint64))
        return (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)
    order = np.argsort(key, kind="stable")
    return order, key[order]


def _ranks(order: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks by place, and the largest."""
    step = np.empty(len(keys), np.uint64)
    step[0] = 0
    step[1:] = keys[1:] != keys[:-1]
    dense = np.cumsum(step, dtype=np.uint64)
    ranks = np.empty(len(keys), np.uint64)
    ranks[order] = dense
    return ranks, int(dense[-1])


def _word_order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places by code. The upper bits are sorted with the places; the few words that share them are put right."""
    bits = max(len(codes) - 1, 1).bit_length()
    order, _ = _sorted_by(codes >> np.uint64(bits), (1 << 64 - bits) - 1)
    keys = codes[order]
    if (keys[1:] < keys[:-1]).any():
        order = np.argsort(codes, kind="stable")
        keys = codes[order]
    return order, keys


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in the order of their first `depth` codes or more."""
    order, keys = _word_order(codes)
    ranks, most = _ranks(order, keys)
    known = 1
    while known < depth and most < len(codes) - 1:
        key = ranks * np.uint64(most + 2)
        key[: len(codes) - known] += ranks[known:] + np.uint64(1)
        order, keys = _sorted_by(key, (most + 1) * (most + 2))
        ranks, most = _ranks(order, keys)
        known *= 2
    return order


# -- the benchmark -------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """Some benchmark items: their codes, and every suffix that can hold a window."""

    names: list[str]
    codes: np.ndarray
    at: np.ndarray
    length: np.ndarray
    window: np.ndarray
    item: np.ndarray
    item_start: np.ndarray

    @cached_property
    def depth(self) -> int:
        return int(self.length.max(initial=1))


def block_of(items: list[tuple[str, str]], window: int) -> Block:
    """The suffixes of (name, text) items; an item of fewer words than a window, but not none, is one window."""
    words = words_of_texts(pa.array([text for _, text in items], pa.string()))
    counts = words.counts
    size = np.minimum(counts, window)
    n = np.where(counts > 0, counts - size + 1, 0)
    item = np.repeat(np.arange(len(items)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = words.begins[:-1][item] + start
    small = lambda x: x.astype(np.int32)
    return Block([name for name, _ in items], words.codes, at, small(counts[item] - start), small(size[item]), small(item), small(start))


def blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of `benchmark` (item_id, text) in blocks of about `block_bytes`; one where they are few.

    The size is summed up in Spark first. More blocks than one are parts by a
    hash of the row, so each is about as large and none is larger than that and
    its longest text.
    """
    rows = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("name"), text_of(benchmark).alias("text")).distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total * 5 // (4 * block_bytes)) if total > block_bytes else 1)
    part = F.pmod(F.xxhash64("name", "text"), F.lit(parts))
    for k in range(parts):
        chosen = rows if parts == 1 else rows.where(part == k)
        yield block_of([(r["name"], r["text"]) for r in chosen.collect()], window)


# -- the search ----------------------------------------------------------------


def _common(codes: np.ndarray, at: np.ndarray, block: Block, test: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of a training and a test suffix: how many codes agree, `most` at most, and whether the training one is less."""
    same, less = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    active, k = np.arange(len(at)), 0
    last = len(codes) - 1
    while len(active):
        active = active[most[active] > k]
        a = codes[np.minimum(at[active] + k, last)]
        b = block.codes[test[active] + k]
        equal = (a == b) & (at[active] + k <= last)
        less[active[~equal]] = (a < b)[~equal]
        active = active[equal]
        k += 1
        same[active] = k
    return same, less


def _bound(codes: np.ndarray, array: np.ndarray, block: Block, test: np.ndarray, most: np.ndarray, past: bool) -> np.ndarray:
    """The first place in the array that is not before a test suffix, or with `past` the first behind all that begin like it."""
    low, high = np.zeros(len(test), np.int64), np.full(len(test), len(array))
    active = np.arange(len(test))
    while len(active := active[low[active] < high[active]]):
        middle = (low[active] + high[active]) // 2
        same, less = _common(codes, array[middle], block, test[active], most[active])
        if past:
            less |= same == most[active]
        low[active[less]] = middle[less] + 1
        high[active[~less]] = middle[~less]
    return low


@dataclass(frozen=True)
class Found:
    """Of one shard: which codes lie in a window, and the longest match of each (text, item)."""

    hit: np.ndarray
    text: np.ndarray
    item: np.ndarray
    longest: np.ndarray
    item_start: np.ndarray
    doc_start: np.ndarray


def search(words: Words, block: Block) -> Found:
    codes = words.codes
    hit = np.zeros(len(codes) + 1, np.int64)
    best = [np.zeros(0, np.int64)] * 5
    if len(block.at) and len(codes):
        array = suffix_array(codes, block.depth)
        at, length, window = block.at, block.length.astype(np.int64), block.window.astype(np.int64)
        low = _bound(codes, array, block, at, length, past=False)
        # The longest match stands next to where the suffix would: before it or behind it.
        longest = np.zeros(len(at), np.int64)
        for side in (low - 1, low):
            there = np.flatnonzero((side >= 0) & (side < len(array)))
            longest[there] = np.maximum(longest[there], _common(codes, array[side[there]], block, at[there], length[there])[0])
        asked = np.flatnonzero(longest >= window)
        first = _bound(codes, array, block, at[asked], window[asked], past=False)
        n = _bound(codes, array, block, at[asked], window[asked], past=True) - first
        ends = np.cumsum(n)
        for lo in range(0, int(ends[-1]) if len(ends) else 0, PLACES):
            place = np.arange(lo, min(lo + PLACES, int(ends[-1])))
            which = np.searchsorted(ends, place, side="right")
            where = array[first[which] + place - (ends - n)[which]]
            suffix = asked[which]
            hit += np.bincount(where, minlength=len(hit)) - np.bincount(where + window[suffix], minlength=len(hit))
            size, _ = _common(codes, where, block, at[suffix], length[suffix])
            text = np.searchsorted(words.begins, where, side="right") - 1
            new = [text, block.item[suffix].astype(np.int64), size, block.item_start[suffix].astype(np.int64), where - words.begins[text]]
            best = [np.concatenate(c) for c in zip(best, new, strict=True)]
            order = np.lexsort((best[4], best[3], -best[2], best[1], best[0]))
            best = [c[order] for c in best]
            one = np.ones(len(order), bool)
            one[1:] = (np.diff(best[0]) != 0) | (np.diff(best[1]) != 0)
            best = [c[one] for c in best]
    return Found(np.cumsum(hit[:-1]) > 0, *best)


# -- on Spark ------------------------------------------------------------------

_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_ITEM = pa.struct([("item_id", pa.string()), ("longest", pa.int64()), ("item_start", pa.int64()), ("doc_start", pa.int64())])
MATCHES = "spans array<struct<start:long,end:long>>, items array<struct<item_id:string,longest:long,item_start:long,doc_start:long>>"


def _lists(per_text: np.ndarray, kind: pa.StructType, columns: list[pa.Array]) -> pa.Array:
    """Rows in the order of their texts as one list for each text; `per_text` counts them."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(kind)))


def _spans(words: Words, hit: np.ndarray) -> pa.Array:
    """Runs of hit words, counted from the text's first word."""
    edge = np.diff(hit.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text = np.searchsorted(words.begins, start, side="right") - 1
    own = words.begins[text]
    return _lists(np.bincount(text, minlength=len(words.begins) - 1), _SPAN, [pa.array(start - own), pa.array(end - own)])


def _items(n: int, found: Found, block: Block) -> pa.Array:
    names = pa.array([block.names[i] for i in found.item.tolist()], pa.string())
    numbers = [pa.array(c, pa.int64()) for c in (found.longest, found.item_start, found.doc_start)]
    return _lists(np.bincount(found.text, minlength=n), _ITEM, [names, *numbers])


def _seen(words: Words, spans: pa.Array) -> np.ndarray:
    """The hits of earlier blocks, from their spans."""
    hit = np.zeros(len(words.codes) + 1, np.int64)
    text = np.repeat(np.arange(len(spans)), np.diff(spans.offsets.to_numpy()))
    flat = spans.flatten()
    for name, sign in (("start", 1), ("end", -1)):
        np.add.at(hit, words.begins[text] + flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64), sign)
    return np.cumsum(hit[:-1]) > 0


def _match_task(sent, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for whole in batches:
            for part in byte_slices(whole, "text", shard_bytes):
                words = words_of_texts(part.column("text"))
                found = search(words, block)
                hit = found.hit | _seen(words, part.column("spans"))
                columns = {
                    "n_words": pa.array(words.counts),
                    "spans": _spans(words, hit),
                    "items": pa.array([a + b for a, b in zip(part.column("items").to_pylist(), _items(part.num_rows, found, block).to_pylist(), strict=True)], pa.list_(_ITEM)),
                }
                yield pa.RecordBatch.from_arrays([columns.get(c, part.column(c)) for c in part.schema.names], part.schema.names)

    return run


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) for each row of `docs` (doc_id, text) against `benchmark` (item_id, text).

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is
    `window` consecutive words of an item; an item of fewer, but not none, is one
    window. `spans` are the runs of document words inside any occurrence of a
    window, as word positions, end exclusive, and `n_hit` their words. `items` has
    one entry per item row with an occurring window: its id, the words of its
    longest verbatim match here, and where that begins in item and document.

    Null texts have no words; null item_ids are the empty name; item rows that
    repeat count once, and rows that share an id only are one item in several
    entries. Repeated rows of `docs` stay. Other columns are not read. Empty tables
    on either side give no match.

    The size of the benchmark is summed up first. It is sent to the tasks in
    blocks of `block_bytes`, one pass over the documents for each.
    """
    spark = docs.sparkSession
    none = [F.array().cast(kind).alias(name) for name, kind in (c.split(" ", 1) for c in MATCHES.split(", "))]
    found = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), F.lit(0).cast("long").alias("n_words"), *none)
    schema = f"doc_id long, text string, n_words long, {MATCHES}"
    for k, block in enumerate(blocks(benchmark, window, block_bytes)):
        before = written(found, "matches") if k else found  # one search at a time in a worker's memory
        found = map_batches(before, _match_task(spark.sparkContext.broadcast(block), shard_bytes), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items")


def _clean_task(sent, text: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for whole in batches:
            for part in byte_slices(whole, text, shard_bytes):
                words = words_of_texts(part.column(text))
                hit = np.concatenate([[0], np.cumsum(search(words, block).hit)])
                clean = hit[words.begins[1:]] == hit[words.begins[:-1]]
                yield part.filter(pa.array(clean))

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of `docs` without those that hold a window of the benchmark; see `matches`. Columns stay."""
    text = "text of the search"
    while text in docs.columns:
        text += "_"
    found = docs.select(*(docs[c] for c in docs.columns), text_of(docs).alias(text))
    schema = ", ".join(f"`{c.replace('`', '``')}` {kind}" for c, kind in found.dtypes)
    for k, block in enumerate(blocks(benchmark, window, block_bytes)):
        before = written(found, "clean") if k else found
        found = map_batches(before, _clean_task(docs.sparkSession.sparkContext.broadcast(block), text, shard_bytes), schema)
    return found.drop(text)
