"""Data-quality checks. Each returns its violation rows (empty = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import to_cents


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Q1 `unique`: values of `col` that occur more than once (NULLs ignored).
    A partial aggregate per task first, so a hot value costs one row per task."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    """Q2 `not_null`: the rows whose `col` is NULL."""
    return df.filter(F.col(col).isNull())


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL count per column in one pass: (column_name, n_null, n_rows)."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"),
                 F.col("_rows").alias("n_rows")) for c in cols])).alias("r")).select("r.*")


def amount_violations(df: DataFrame) -> DataFrame:
    """Q4: lines whose total differs from unit price × quantity (to the cent),
    compared in integer cents."""
    expected = to_cents("unit_price") * F.col("quantity").cast("bigint")
    return (df.filter(expected != F.col("total_cents"))
            .select("transaction_id", "unit_price", "quantity",
                    (F.col("total_cents").cast("double") / 100).alias("total_amount"),
                    (expected.cast("double") / 100).alias("expected_amount")))


def documentation_gaps(columns: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Q5: for each documented column what the catalog lacks. `columns` is
    (column_name, comment); result (column_name, expected_comment, problem), problem NULL
    where the catalog's comment is the documented one."""
    spark = columns.sparkSession
    want = spark.createDataFrame(list(expected.items()),
                                 "column_name string, expected_comment string")
    have = columns.select("column_name", F.col("comment").alias("_has"), F.lit(True).alias("_in"))
    problem = (F.when(F.col("_in").isNull(), "missing column")
               .when(F.coalesce("_has", F.lit("")) == "", "no comment")
               .when(F.col("_has") != F.col("expected_comment"), "another comment"))
    return want.join(have, "column_name", "left").select(
        "column_name", "expected_comment", problem.alias("problem"))
