"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the documents of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pathloom.llm.packing import pack
from pathloom.llm.quality import keep_good
from pathloom.llm.secret_scan import redact_secrets
from pathloom.llm.simhash import keep_one
from pathloom.llm.suffix_dedup import cut_repeats
from pathloom.storage import freeze

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings that an earlier one, or the same one before, has too."""
    return cut_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("secrets", secrets),
    ("packing", packing),
]

# Fingerprints, bucket refinement, lexing and the tokenizer are beyond SQL; the tests compare
# every stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
