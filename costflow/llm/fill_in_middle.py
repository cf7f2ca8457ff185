"""Fill-in-the-middle texts: whole batches of bytes moved by one displacement scatter, and moved back by a gather.

A batch is one buffer of UTF-8 bytes. Its cuts are looked up among the starts of
its code points. Every byte of a piece moves by the same distance, so a
difference array holds the change of distance where a piece begins; its running
sum is the distance of every byte, and one scatter writes all outputs. Reading
back finds the three markers, builds the same kind of array over the restored
bytes and gathers them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from costflow.llm.common import buffer_of, byte_slices, map_batches, text_of

# Fixed values of the contract: what stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3

#: Forms by number, in the order that `restore` and `transform` use.
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)

#: Texts are moved together up to so many bytes; a longer text is moved alone.
SLICE_BYTES = 1 << 22


@dataclass(frozen=True)
class Rates:
    """The seed, and of 100 texts how many stay plain and how many of the rest put the suffix first."""

    seed: str = "1"
    plain: int = 10
    suffix_first: int = 20


def draws(ids: list[int | None], seed: str) -> np.ndarray:
    """Four unsigned 32-bit numbers per row: the first half of SHA-256 of `seed:id`; an id of null is empty."""
    heads = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(heads), ">u4").astype(np.int64).reshape(-1, 4)


# -- buffers of many texts -----------------------------------------------------


def texts_of(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """`buffer_of` the other way round."""
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def _marks(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a marker begins, without those that two texts form together, and how many each text holds."""
    at = np.flatnonzero(data[:-2] == PREFIX[0]) if len(data) >= MARK else np.zeros(0, np.int64)
    kind = data[at + 1]
    at = at[(data[at + 2] == PREFIX[2]) & ((kind == PREFIX[1]) | (kind == SUFFIX[1]) | (kind == MIDDLE[1]))]
    at = at[at + MARK <= begins[np.searchsorted(begins, at, side="right")]]
    return at, np.diff(np.searchsorted(at, begins))


def _displacements(n: int, pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n bytes the distance from its place in the pieces' first coordinate to that in their second.

    `pieces` holds (from, to, length) arrays that together cover 0 to n once.
    """
    begin, to, length = (np.concatenate(c) for c in zip(*pieces, strict=True))
    begin, to = begin[length > 0], to[length > 0]
    order = np.argsort(begin, kind="stable")
    change = np.zeros(n + 1, np.int64)
    change[begin[order]] = np.diff((to - begin)[order], prepend=0)
    return np.cumsum(change[:n])


@dataclass(frozen=True)
class Cut:
    """One batch taken apart: per text its code points, form, and lengths of prefix and middle in code points."""

    n: np.ndarray
    form: np.ndarray
    prefix: np.ndarray
    middle: np.ndarray
    output: pa.Array


def transform(texts: pa.Array, numbers: np.ndarray, rates: Rates) -> Cut:
    """Cut and reorder the texts of one slice; no text is null."""
    data, begins = buffer_of(texts)
    points = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(points, begins)
    n = np.diff(first)
    h = numbers % np.stack([n + 1, n + 1, np.full(len(n), 100), np.full(len(n), 100)], axis=1)
    low, high = np.minimum(h[:, 0], h[:, 1]), np.maximum(h[:, 0], h[:, 1])
    form = np.where(h[:, 3] < rates.suffix_first, SPM, PSM)
    form[(n == 0) | (_marks(data, begins)[1] > 0) | (h[:, 2] >= 100 - rates.plain)] = PLAIN

    places = np.append(points, len(data))
    a, d = begins[:-1], begins[1:]
    b, c = places[first[:-1] + low], places[first[:-1] + high]
    moved = form != PLAIN
    ends = np.concatenate([[0], np.cumsum(d - a + np.where(moved, 3 * MARK, 0))])
    lead = ends[:-1]  # where the output begins
    spm = form == SPM
    # Where prefix, suffix and middle begin in the output; a plain text is a prefix as long as itself.
    whole = np.where(moved, 0, d - a)
    to_prefix = lead + np.where(moved, np.where(spm, 2 * MARK + d - c, MARK), 0)
    to_suffix = lead + np.where(spm, MARK, 2 * MARK + b - a)
    to_middle = lead + 3 * MARK + (b - a) + (d - c)
    shift = _displacements(
        len(data),
        [
            (a, to_prefix, np.where(moved, b - a, whole)),
            (b, to_middle, np.where(moved, c - b, 0)),
            (c, to_suffix, np.where(moved, d - c, 0)),
        ],
    )
    out = np.empty(int(ends[-1]), np.uint8)
    out[np.arange(len(data)) + shift] = data
    for mark, at in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        out[(at[moved] - MARK)[:, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    return Cut(n, form, low, high - low, texts_of(out, ends))


def restore(outputs: pa.Array, form: np.ndarray) -> pa.Array:
    """The texts again, from the outputs of one slice and their forms alone."""
    data, begins = buffer_of(outputs)
    moved = form != PLAIN
    a, d = begins[:-1], begins[1:]
    at, held = _marks(data, begins)
    at = at[np.repeat(moved, held)].reshape(-1, 3)
    # Piece k of an output runs from behind its marker to the next marker or the end.
    start = at + MARK
    stop = np.column_stack([at[:, 1:], d[moved]])
    spm = form[moved] == SPM
    prefix, suffix = np.where(spm, 1, 0), np.where(spm, 0, 1)
    rows = np.arange(len(at))
    size = stop - start
    ends = np.concatenate([[0], np.cumsum(d - a - np.where(moved, 3 * MARK, 0))])
    to_prefix = ends[:-1][moved]
    to_middle = to_prefix + size[rows, prefix]
    to_suffix = to_middle + size[:, 2]
    shift = _displacements(
        int(ends[-1]),
        [
            (ends[:-1][~moved], a[~moved], (d - a)[~moved]),
            (to_prefix, start[rows, prefix], size[rows, prefix]),
            (to_middle, start[:, 2], size[:, 2]),
            (to_suffix, start[rows, suffix], size[rows, suffix]),
        ],
    )
    return texts_of(data[np.arange(len(shift)) + shift], ends)


# -- on Spark ------------------------------------------------------------------


def _transform_task(rates: Rates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in byte_slices(whole, "text", SLICE_BYTES):
                cut = transform(part.column(1), draws(part.column(0).to_pylist(), rates.seed), rates)
                plain = cut.form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(cut.n),
                        pa.array([FORMS[k] for k in cut.form], pa.string()),
                        pa.array(cut.prefix, mask=plain),
                        pa.array(cut.middle, mask=plain),
                        cut.output,
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of `docs` (doc_id, text).

    Two numbers drawn from the doc_id cut the text's n code points into prefix,
    middle and suffix; a third leaves some texts plain, a fourth puts the suffix
    first in some. Outputs: the text; `<P>`prefix`<S>`suffix`<M>`middle (psm);
    `<S>`suffix`<P>`prefix`<M>`middle (spm). Empty texts, and texts that hold a
    marker, are plain; the lengths of a plain text's pieces are null.

    Null texts are empty. Rows that repeat a doc_id are cut alike, and those
    without one as the empty id. Other columns are not read. An empty table gives
    an empty one. Nothing is shuffled.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_batches(narrow, _transform_task(rates), schema)


def _restore_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        names = whole.schema.names
        for part in byte_slices(whole, "output", SLICE_BYTES):
            form = np.array([FORMS.index(f) for f in part.column("form").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns, restore(part.column("output"), form)], [*names, "restored"])


def restored(cut: DataFrame) -> DataFrame:
    """`cut` (with `form` and `output`, as from `fill_in_middle`) plus `restored`, the text made from these two alone."""
    cut = cut.drop("restored")
    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in cut.dtypes), "restored string"])
    return map_batches(cut, _restore_task, schema)
