"""Documents from raw to packed sequences, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again. Rows with null ids
or texts go through like others (a null text counts as empty); an empty table stays empty. All
stages but the last return the columns of documents, whatever these are called.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontamination, exact, packing, simhash, toxicity
from shelfline.llm.store import stored, table
from shelfline.llm.tokens import LESS_MEMORY


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the classifier predicts to be toxic."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest of the documents that are equal without white space."""
    return exact.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents in which a window of a benchmark item occurs."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, packed into sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), memory=LESS_MEMORY)


STAGES = [
    ("toxicity", toxic_documents),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("packing", sequences),
]

#: A classifier and a tokenizer are not SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
