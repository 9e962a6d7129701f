"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; `run`
writes every stage's result to the shared folder and reads it back as the next one's
documents. No SQL is given for the rows: a learned classifier and token ids have no SQL
form, so the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import exact_dedup, mixing, near_dedup, packing, quality
from tillroll.llm.common import table
from tillroll.operators.materialize import written

ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this stage's input, accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return near_dedup.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i + 1}")
    return docs
