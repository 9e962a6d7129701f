"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after lower-casing A-Z; NULL counts as empty. Each
text is reduced to its SHA-256, and the row with the largest doc_id of each digest
stays.

1. A Misra-Gries summary (Spark's frequent-items sketch, one per task, merged in two
   levels) names at most ``HEAVY`` digests that may be frequent: every digest with
   over N / (0.75 * COUNTERS) of the N rows is among them.
2. The candidates are verified by an exact count. The verified winners, at most
   ``HEAVY`` rows, are broadcast: rows of a heavy digest are answered where they are
   and take no part in a shuffle.
3. All other digests, each with a small share of the rows, are aggregated with
   map-side partial sums and joined back by an ordinary shuffle.

Defined cases: NULL doc_ids rank below all others; of rows with the same doc_id and
equal texts one (any; they are alike) stays; an empty table gives an empty result;
other columns, whatever their names, are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.materialize import written
from .common import ascii_lower, text_of

COUNTERS = 4096
HEAVY = 1024
_MERGERS = 64
_LOWEST = -(1 << 63)


def text_digest(text_col: str):
    return F.unhex(F.sha2(ascii_lower(text_of(text_col)), 256))


def _winners(rows: DataFrame) -> DataFrame:
    # max and max_by keep fixed-width state, so this is a hash aggregate
    return rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"),
        F.max_by("tag", F.coalesce("doc_id", F.lit(_LOWEST))).alias("keep_tag"),
        F.count(F.lit(1)).alias("group_size"))


def heavy_digests(digests: DataFrame) -> list[int]:
    """Up to HEAVY 64-bit digest prefixes that may be frequent (Misra-Gries)."""
    partial = (digests.groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("m"))
               .agg(F.expr(f"approx_top_k_accumulate(prefix, {COUNTERS})").alias("sketch")))
    # grouped by a constant: an ungrouped merge fails in tasks that get no sketch
    top = partial.groupBy((F.col("m") * 0).alias("all")).agg(F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(sketch, {COUNTERS}), {HEAVY})").alias("t"))
    row = top.first()
    return [x["item"] for x in row["t"] if x["count"] > 1] if row else []


def digest_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, prefix, tag), written once; tag tells repeated rows apart."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest"))
    return written(d.select("doc_id", "digest", F.xxhash64("digest").alias("prefix"),
                            F.monotonically_increasing_id().alias("tag")), "digests")


def split_heavy(digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verified winners of the heavy digests, at most HEAVY rows; rows of all others)."""
    found = digests.filter(F.col("prefix").isin(heavy_digests(digests)))
    verified = written(_winners(found).filter("group_size > 1"), "heavy-digests")
    rest = digests.join(F.broadcast(verified.select("digest")), "digest", "left_anti")
    return verified, rest


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = digest_table(docs, id_col, text_col)
    heavy, rest = split_heavy(digests)
    light = written(_winners(rest).filter("group_size > 1"), "light-digests")
    hot = digests.join(F.broadcast(heavy), "digest")
    cold = rest.join(light, "digest", "left")
    out = hot.select(*cold.columns).unionByName(cold)
    kept = F.coalesce(F.col("tag") == F.col("keep_tag"), F.lit(True))
    return out.select(
        "doc_id",
        F.when(F.col("keep_tag").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns as they were.

    Rows of heavy digests are dropped on the map side by the broadcast winners; the
    others meet by digest, after a map-side group limit of one row per digest."""
    heavy, _ = split_heavy(digest_table(docs, id_col, text_col))
    cols = docs.columns
    t = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                    F.col(id_col).cast("long").alias("doc_id"),
                    text_digest(text_col).alias("digest"))
    t = t.join(F.broadcast(heavy.select("digest", "keep_id", F.lit(True).alias("is_heavy"))),
               "digest", "left")
    t = t.filter(F.col("is_heavy").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    w = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())
    t = t.withColumn("n", F.row_number().over(w)).filter("n = 1")
    return t.select("row.*")
