"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"\x20\x09-\x0D"
WORD = rf"[^{WHITE}]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: Column | str) -> Column:
    """The text itself, NULL read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the byte-wise ``lower``."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, _UPPER, _UPPER.lower())))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def doc_hash(c: Column) -> Column:
    """CRC-32 of a document id's decimal text, for stable train / held-out splits."""
    return F.crc32(c.cast("string").cast("binary"))
