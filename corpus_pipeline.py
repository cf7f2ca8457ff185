"""Documents to token sequences in five stages; each takes the rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costflow.llm import line_dedup, mixing, packing, quality_rules, simhash
from costflow.llm.common import table, written
from costflow.llm.queries import tokenizer_path

#: SQL has neither XXH64 fingerprints nor a tokenizer; tests/llm/test_pipeline.py holds each stage against plain Python.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the lines that many share; n_chars follows the text."""
    kept = line_dedup.drop_shared_lines(docs)
    changed = {
        "text": F.col("kept_text"),
        "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None,
    }
    return kept.select(*((changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by their sources' rates, in random order."""
    return mixing.mix(docs).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a document that stage 4 repeats is packed each time."""
    return packing.packed_pieces(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over `documents`; the stages hand each other written tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
