"""From raw documents to training sequences: each stage works on all that the stage before has kept.

Stages take (spark, docs, directory of the tables) and return a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm import language, mixing, near_duplicates, packing, privacy
from tallyward.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def recognise(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Documents in a language that the profiles know; others go."""
    return language.recognised_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """One document of each group of near duplicates, by shingles of five words."""
    return near_duplicates.distinct_documents(docs)


def mask(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """All documents, with personal data masked."""
    return privacy.masked_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Documents as often as the mixture of the sources takes them; the next stage deals the sources out anew, so in no order."""
    return mixing.mixed_documents(docs, ordered=False)


def pack(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", recognise),
    ("near_duplicates", deduplicate),
    ("private_data", mask),
    ("mixing", mix),
    ("packing", pack),
]

# Byte-pair encoding and rank-order profiles are no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, directory), f"pipeline-{name}")
    return docs
