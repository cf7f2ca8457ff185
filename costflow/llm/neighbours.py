"""Quality by nearest labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import map_batches, text_of

#: Hashed byte trigrams, and behind them one term per lag: words equal to the one so many before.
#: The latter stand out among the many others by a weight.
HASHED = 2048
LAGS = (1, 2, 3, 4)
LAG_WEIGHT = 4
TERMS = HASHED + len(LAGS)
#: Latent dimensions, and neighbours that vote.
LATENT = 64
NEIGHBOURS = 25
#: At most so many labelled documents are fitted and searched, the first by a hash of their ids.
MAX_LABELLED = 6000
#: Similarity counts by this power, so that close neighbours outweigh the rest.
SHARPNESS = 8
#: Similarities this near to each other are ties, whatever the order of their sums.
TIE = 1e-5
THRESHOLD = 0.7
BLOCK = 256

# Fixed values of the hold-out rule.
FOLDS, HELD_FOLD = 4, 2


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the held remainder; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


# -- vectors -------------------------------------------------------------------


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte trigrams of the lower-cased text, and of repeated words by lag."""
    counts = np.zeros(TERMS, np.int64)
    plain = text.lower()
    data = np.frombuffer(plain.encode("utf-8"), np.uint8).astype(np.uint32)
    if len(data) >= 3:
        key = (data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]) * np.uint32(2654435761)
        counts[:HASHED] = np.bincount(key >> np.uint32(32 - 11), minlength=HASHED)
    words = plain.split()
    counts[HASHED:] = [sum(map(eq, words, words[lag:])) for lag in LAGS]
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of log counts times idf, of length 1 (0 for a text without terms)."""
    rows = np.log1p(counts).astype(np.float32) * idf
    rows[:, HASHED:] *= LAG_WEIGHT
    return _unit(rows)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _frequency_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            total += term_counts(text) > 0
        n += batch.num_rows
    cells = np.append(total, n)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["term", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Idf of each hashed term over all documents; one number per term reaches the driver."""
    parts = map_batches(docs.select(text_of(docs).alias("text")), _frequency_task, "term long, n long")
    counts = np.zeros(TERMS + 1)
    for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return np.log((1 + counts[-1]) / (1 + counts[:-1])).astype(np.float32) + np.float32(0.01)


# -- fit -----------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Basis (terms x latent), labelled vectors (rows x latent) and their labels: of bounded size."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(weighted(counts, self.idf) @ self.basis)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, by similarity; ties all vote."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        least = np.partition(cosine, -k, axis=1)[:, -k, None]
        weight = np.where(cosine >= least - TIE, np.maximum(cosine, 0), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        vote = weight @ self.labels
        known = (total > 1e-12) & (counts.sum(axis=1) > 0)
        return np.where(known, vote / np.where(known, total, 1), self.prior)


def _counts_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, labels = batch.columns
        rows = [term_counts(t).astype("<u4").tobytes() for t in texts.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), labels], ["counts", "label"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """The model from at most `max_labelled` labelled documents that are not held out.

    The sample (8 KB a document) is all that the driver gathers; the term
    statistics cover all documents. Rows without an id or a label are left out.
    """
    usable = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label")).dropna()
    sample = (
        usable.where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    rows = map_batches(joined.select("text", "label"), _counts_task, "counts binary, label int").collect()
    idf = inverse_frequencies(docs)
    if not rows:
        return Model(idf, np.zeros((TERMS, LATENT), np.float32), np.zeros((0, LATENT), np.float32), np.zeros(0))
    rows.sort(key=lambda r: (bytes(r["counts"]), r["label"]))
    counts = np.frombuffer(b"".join(bytes(r["counts"]) for r in rows), "<u4").reshape(len(rows), TERMS)
    matrix = weighted(counts, idf)
    values, vectors = np.linalg.eigh(matrix.T @ matrix)
    basis = vectors[:, ::-1][:, :LATENT].astype(np.float32)
    return Model(idf, basis, _unit(matrix @ basis), np.array([float(r["label"]) for r in rows]))


# -- score ---------------------------------------------------------------------


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs` (doc_id, text).

    The model is broadcast: MAX_LABELLED rows at most. Every document is held
    against all its vectors, a block of documents at a time. Null and empty
    texts get the share of label 1 in the sample. Repeated rows are scored each;
    other columns are not read. An empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                counts = np.stack([term_counts(t) for t in part.column(1).to_pylist()])
                values = np.round(shared.value.scores(counts), 6)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], ["doc_id", "score"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    scored = map_batches(narrow, run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
