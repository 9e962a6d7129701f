"""The two starter models and their declared tests.

They run on a two-row constant, so they are library functions with unit tests,
not registered queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_model(spark: SparkSession) -> DataFrame:
    """`select 1 as id union all select null as id` (fails not_null by design)."""
    one = spark.range(1).select(F.lit(1).cast("int").alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionAll(null)


def second_model(first: DataFrame) -> DataFrame:
    """`select * from first where id = 1` (NULL ids drop out)."""
    return first.filter(F.col("id") == 1)
