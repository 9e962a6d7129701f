"""The registered queries of the text operators: thin applications to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (clustering, exact_dedup, language_id, license_scan, line_dedup, mixing, near_dedup,
               packing, quality, secret_scan, spelling, token_files, topk)
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "part")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_components(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles here; the operator's default is five."""
    return near_dedup.near_components(table(spark, sf_dir, "documents"), k=2)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clustered(table(spark, sf_dir, "embeddings"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encoded(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_line_dedup, op3_language_id, op4_secret_scan, op5_packing, op6_topk,
    op7_license_scan, op8_near_dedup, op9_exact_dedup, op10_quality, op11_spelling_variants,
    op12_clustering, op13_token_files)}
QUERIES["pipeline"] = corpus_pipeline.run
