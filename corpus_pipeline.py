"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again.

Quality classifier, SimHash near-duplicates, benchmark decontamination, mixing
to target weights, token ids.  The first four return the columns of
``documents``, the last one row per document of the token-id files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm.decontaminate import decontaminate
from salesmart.llm.mixing import mixed_documents
from salesmart.llm.quality_mil import keep_good
from salesmart.llm.queries import vocabulary
from salesmart.llm.simhash import keep_one
from salesmart.llm.token_ids import token_ids
from salesmart.session import configure, stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more."""
    return keep_good(docs, _table(spark, sf_dir, "labels"), 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates."""
    return keep_one(docs, width=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated rows for repetitions, none for those left out."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of all rows, read back: ``doc_id, start, n_tokens, ids_crc32``."""
    return token_ids(docs, vocabulary()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing_sources", mixing),
    ("token_ids", token_output),
]

#: A trained classifier, a hash of word shingles and token ids are not for SQL; tests/llm compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = _table(configure(spark), sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
