"""Documents as token sequences of one length: minimum bin slack by subset sums."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import map_batches, text_of, written

CAPACITY = 4096
END_ID = 2
#: Pieces that one task packs; their lengths and ids are in its memory.
PIECES_PER_TASK = 40_000
#: Words whose ids a worker remembers, twice: those met lately and those met before.
REMEMBERED = 300_000
#: Words that are encoded as one string.
JOINED = 2048


# -- tokens --------------------------------------------------------------------


TAIL = ".,;:!?"


class WordIds:
    """Token ids by white-space separated words; a word met lately is not encoded again.

    Right for tokenizers that split at white space, drop it, split letters from
    marks and close every such part with an end-of-word token, as
    `word_bpe_49k.json` does (`tests/llm` compares whole texts). Words of letters
    alone, with marks behind them at most, are encoded many at a time and told
    apart by their end-of-word tokens; all others one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.lately: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self._encoded(texts)]

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of letters alone."""
        out = {}
        for at in range(0, len(words), JOINED):
            part = words[at : at + JOINED]
            ids = np.array(self._encoded([" ".join(part)])[0], "<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(ends) != len(part):  # a word that normalisation takes apart
                out.update(zip(part, self._raw(part), strict=True))
                continue
            raw = ids.tobytes()
            out.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        return out

    def _learn(self, words: set[bytes]) -> None:
        plain, other, letters = [], [], {}
        for word in words:
            text = word.decode("utf-8")
            base = text.rstrip(TAIL)
            if base.isalpha() and (base.isascii() or base.islower()):
                low = base.lower()
                plain.append((word, low, text[len(base) :]))
                if low not in letters:
                    key = low.encode("utf-8")
                    letters[low] = self.lately.get(key) or self.before.get(key)
            else:
                other.append((word, text))
        letters |= self._letters([base for base, ids in letters.items() if ids is None])
        tails = list({tail for _, _, tail in plain})
        marks = dict(zip(tails, self._raw(tails), strict=True))
        self.lately.update((word, letters[base] + marks[tail]) for word, base, tail in plain)
        self.lately.update(zip((w for w, _ in other), self._raw([t for _, t in other]), strict=True))

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, 32 bits each, little-endian."""
        split = [t.encode("utf-8").split() for t in texts]
        new = set().union(*split).difference(self.lately)
        known = new.intersection(self.before)
        self.lately.update((w, self.before[w]) for w in known)
        self._learn(new - known)
        out = [b"".join(map(self.lately.__getitem__, words)) for words in split]
        if len(self.lately) > REMEMBERED:
            self.before, self.lately = self.lately, {}
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker and file, kept for its later tasks."""
    return WordIds(path)


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = word_ids(path), end_id.to_bytes(4, "little")
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), known.of(batch.column(1).to_pylist()), strict=True):
                    ids += end
                    n = len(ids) // 4
                    rows += [(doc_id, s, min(capacity, n - s), n, ids[4 * s : 4 * (s + capacity)]) for s in range(0, n, capacity)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "ids"])

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids) for `docs` (doc_id, text).

    A document's ids and `end_id`, cut every `capacity` ids; `ids` is binary, 32
    bits each, little-endian. A null or blank text is the piece of `end_id` alone.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"
    return map_batches(narrow, _pieces(tokenizer_path, capacity, end_id), schema)


# -- minimum bin slack ---------------------------------------------------------


def fill(counts: dict[int, int], order: list[int], room: int) -> dict[int, int]:
    """How many of each length fill `room` best: a subset-sum over the multiset.

    Bit s of `reach` is set if some choice sums to s. Each step adds a bundle of
    1, 2, 4, ... of one length; the states before each step lead back from the
    largest sum reached to the counts. `order` has the lengths with a count.
    """
    reach, full = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in order:
        if length > room:
            continue
        left, bundle = min(counts[length], room // length), 1
        while left > 0:
            take = min(bundle, left)
            steps.append((reach, length, take))
            reach = (reach | reach << (length * take)) & full
            left, bundle = left - take, bundle * 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def minimum_bin_slack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of positions in `lengths`; every position is in one bin.

    Each bin takes the longest piece left and then the multiset of remaining
    lengths that comes closest to the room.
    """
    where: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        where.setdefault(n, []).append(i)
    order = sorted(where, reverse=True)
    counts = {n: len(where[n]) for n in order}
    bins = []
    while order:
        first = order[0]
        counts[first] -= 1
        chosen = fill(counts, [n for n in order if counts[n]], capacity - first) if first < capacity else {}
        own = [where[first].pop()]
        for n, k in chosen.items():
            counts[n] -= k
            own += [where[n].pop() for _ in range(k)]
        bins.append(own)
        if not counts[first] or any(not counts[n] for n in chosen):
            order = [n for n in order if counts[n]]
    return bins


def _pack_task(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        task = TaskContext.get().partitionId()
        lengths = rows.column("length").to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k, own in enumerate(minimum_bin_slack(lengths, capacity)):
            at = 0
            for i in own:
                sequence[i], offset[i] = (task << 32) + k, at
                at += lengths[i]
        rows = rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from rows.to_batches(max_chunksize=5000)

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """`cut` (with `length`, at most `capacity`) plus sequence_id and offset.

    Pieces are dealt evenly over tasks of about `pieces_per_task`, whatever
    their documents; each task packs its own. Offsets of a sequence are gapless
    from 0. Columns of `cut` named like the two new ones are replaced. An empty
    table gives an empty one.
    """
    cut = cut.drop("sequence_id", "offset")
    tasks = max(1, ceil(cut.count() / pieces_per_task))
    schema = cut.schema.add("sequence_id", "long").add("offset", "long").simpleString()
    return map_batches(cut.repartition(tasks), _pack_task(capacity), schema.removeprefix("struct<").removesuffix(">"))


def crc32_of(ids: Column) -> Column:
    return F.crc32(ids).cast("long")


def packed_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for `docs` (doc_id, text).

    Repeated rows are packed each. Extra columns are not read.
    """
    cut = pieces(docs, tokenizer_path, capacity).select("doc_id", "start", "length", crc32_of(F.col("ids")).alias("ids_crc32"), "doc_tokens")
    return pack(written(cut, "pieces"), capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
