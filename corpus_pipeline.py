"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of documents; the last returns one row for each piece of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import op1_lines, op4_packing, op5_simhash, op7_mixing, op9_quality
from quillon.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, doesn't reject."""
    return op9_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines and runs of 50 words that occur elsewhere before."""
    return op1_lines.dedup_lines(docs, passages=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies."""
    return op5_simhash.keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources as documents: a row for each time that a document is drawn, with the words drawn."""
    return op7_mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of 4096 tokens."""
    return op4_packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: XXH64 fingerprints and tokenizer ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
