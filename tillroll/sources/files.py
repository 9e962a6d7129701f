"""File sources and sinks: raw CSV, processed Parquet, semi-structured (variant)
staging, JSON records and a plain-text report."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import plain_name
from .schema import RAW_COLUMNS, RAW_SCHEMA_WITH_CORRUPT


# ---- A1/A2/H2: raw CSV ------------------------------------------------------------

def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """All shop files under `path` in one scan (the directory is the union): the raw
    columns as text and `_corrupt_record`.

    Names come from the header line and are normalised ("Transaction ID" is
    `transaction_id`), so columns may stand in any order beside others; a missing one
    is an error that names it. No type is inferred: `09:15` stays a string, and a line
    that does not fit the header lands in `_corrupt_record` instead of failing the read.
    Files whose header differs from the first file's are refused, and so is a header in
    which two names become one."""
    header = spark.read.option("header", True).csv(path).columns
    names = [plain_name(c) for c in header]
    twice = [c for c in RAW_COLUMNS if names.count(c) > 1]
    if twice:
        raise ValueError(f"{path}: the header has {', '.join(twice)} more than once")
    missing = [c for c in RAW_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{path}: the header has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, "_corrupt_record"]])
    raw = (spark.read.schema(schema)
           .option("header", True)
           .option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .option("enforceSchema", False)
           # a pruned read would not notice lines with too many fields
           .option("columnPruning", False)
           .csv(path))
    return raw.select(*[F.col(f"`{header[names.index(c)]}`").alias(c) for c in RAW_COLUMNS],
                      "_corrupt_record")


def _csv_writer(df: DataFrame) -> DataFrameWriter:
    """With a header, blanks around values kept (Spark's default strips them)."""
    return (df.write.mode("overwrite").option("header", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_raw_csv(df: DataFrame, path: str, quote: bool = True) -> None:
    """Raw rows as CSV with a header."""
    w = _csv_writer(df)
    (w if quote else w.option("quote", "")).csv(path)


def write_raw_csv_by_shop(df: DataFrame, path: str) -> None:
    """One folder per shop (`shop_id=…`), written in one pass. Rows are
    range-clustered on (shop_id, transaction_id) first: a small shop lands in one
    task and one file, a very large shop is split over several tasks (several
    files in its folder) instead of loading one writer."""
    (_csv_writer(df.repartitionByRange("shop_id", "transaction_id"))
     .partitionBy("shop_id").csv(path))


def read_raw_csv_by_shop(spark: SparkSession, path: str) -> DataFrame:
    """Reads the per-shop folders back; `shop_id` comes from the folder name and
    keeps its text form (partition type inference is off in our sessions)."""
    schema = T.StructType([f for f in RAW_SCHEMA_WITH_CORRUPT.fields if f.name != "shop_id"]
                          + [T.StructField("shop_id", T.StringType())])
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))


# ---- A3/A4: processed Parquet -----------------------------------------------------

def write_processed(df: DataFrame, path: str, increment: bool = False) -> None:
    """A3: processed transactions as Parquet partitioned by (year, month_number).

    Rows are range-clustered on the partition columns first, so each task writes
    into one or two month folders instead of every task writing a small file into
    every month; the transaction id as last range key lets a very busy day
    spread over several tasks. The whole table is replaced, months that are gone from
    the input included; with `increment` only the months present in `df` are. Either
    way a re-run of the same input changes nothing."""
    mode = "dynamic" if increment else "static"
    (df.repartitionByRange("year", "month_number", "date", "transaction_id")
     .write.mode("overwrite").option("partitionOverwriteMode", mode)
     .partitionBy("year", "month_number").parquet(path))


def read_processed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A4: Parquet with the declared schema (partition columns keep their types)."""
    return spark.read.schema(schema).parquet(path)


# ---- C6/V2: point lookups -----------------------------------------------------------

def write_lookup(df: DataFrame, path: str, key: str, others: list[str] | None = None,
                 distinct: int = 1_000_000) -> None:
    """A table for point lookups: rows range-clustered and sorted on `key`, so the row
    groups' bounds tell all but one or two apart, and a Bloom filter per row group on
    `key` and on `others`, whose values lie scattered over the files. `distinct` is the
    number of values that a row group's filter is sized for."""
    w = df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite")
    for c in [key, *(others or [])]:
        w = (w.option(f"parquet.bloom.filter.enabled#{c}", True)
             .option(f"parquet.bloom.filter.expected.ndv#{c}", distinct))
    w.parquet(path)


def lookup(spark: SparkSession, path: str, schema: T.StructType, col: str, value) -> DataFrame:
    """The rows with one value of a column; the filter reaches the Parquet reader."""
    return spark.read.schema(schema).parquet(path).filter(F.col(col) == F.lit(value))


# ---- A5/A6: semi-structured staging ---------------------------------------------

def to_variant_stage(df: DataFrame) -> DataFrame:
    """A5: one semi-structured `raw_data` object per row."""
    return df.select(F.to_variant_object(F.struct(*df.columns)).alias("raw_data"))


def from_variant_stage(stage: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Typed columns by path extraction + cast. `strict` raises on a value
    that does not fit its type; otherwise such a value becomes NULL."""
    get = F.variant_get if strict else F.try_variant_get
    return stage.select(*[get("raw_data", f"$.{f.name}", f.dataType.simpleString())
                          .alias(f.name) for f in schema.fields])


def parse_json_stage(text: DataFrame, col: str = "value") -> DataFrame:
    """JSON text lines → `raw_data` variant beside the line. A malformed line has a NULL
    `raw_data`: `loaded` and `rejected` tell the two apart, so nothing vanishes."""
    return text.select(F.try_parse_json(col).alias("raw_data"), F.col(col).alias("line"))


def loaded(stage: DataFrame) -> DataFrame:
    return stage.filter(F.col("raw_data").isNotNull())


def rejected(stage: DataFrame) -> DataFrame:
    return stage.filter(F.col("raw_data").isNull())


# ---- A12/A13: JSON records and text report ----------------------------------------

def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, lower-case keys, dates and times as strings."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    return lowered.select(F.to_json(F.struct(*lowered.columns)).alias("json"))


def write_json(df: DataFrame, path: str) -> None:
    df.toDF(*[c.lower() for c in df.columns]).write.mode("overwrite").json(path)


def write_text_report(lines: DataFrame, path: str) -> None:
    """A plain-text report: one string column written as lines (one part
    file per task; readers take the folder)."""
    lines.write.mode("overwrite").text(path)
