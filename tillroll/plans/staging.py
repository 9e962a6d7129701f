"""Processed transactions and the `stg_transactions` view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.money import cents_to_amount
from ..operators.clean import clean, critical_null, deduplicated, in_window, valid_values
from ..operators.enrich import enrich
from ..params import FIXTURE, Params
from ..sources import fixture
from ..sources.schema import CRITICAL_COLUMNS

STG_COLUMNS = [
    "transaction_id", "transaction_date", "shop_id", "shop_name", "city",
    "product_name", "category", "quantity", "unit_price", "total_amount",
    "customer_id", "payment_method", "day_of_week", "month_name", "year",
    "month_number", "is_weekend", "revenue_category", "processed_timestamp",
    "day_type", "australian_season", "updated_at",
]


def processed(typed: DataFrame, p: Params, within: Sequence[str] = ()) -> DataFrame:
    """The cleaning job: typed transactions → clean, enriched rows (20 cols + cents).
    `within` as in `deduplicated`."""
    return enrich(clean(typed, p, within), p)


def stg_transactions(processed_df: DataFrame) -> DataFrame:
    """Staging: guard filter, `date` → `transaction_date`, money to 2 dp, day type,
    season and a load timestamp. `total_cents` stays as the exact money column."""
    return (processed_df
            .filter(F.col("transaction_id").isNotNull() & (F.col("total_amount") > 0)
                    & F.col("date").isNotNull())
            .select(
                "transaction_id",
                F.col("date").alias("transaction_date"),
                "shop_id", "shop_name", "city", "product_name", "category", "quantity",
                F.round("unit_price", 2).alias("unit_price"),
                cents_to_amount("total_cents").alias("total_amount"),
                "customer_id", "payment_method", "day_of_week", "month_name", "year",
                "month_number", "is_weekend", "revenue_category", "processed_timestamp",
                cal.day_type("is_weekend").alias("day_type"),
                cal.australian_season("date").alias("australian_season"),
                F.current_timestamp().alias("updated_at"),
                "total_cents",
            ))


def fixture_processed(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    return processed(fixture.dealt_transactions(spark, sf_dir), p, [fixture.ORDER_KEY])


def fixture_stg(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    return stg_transactions(fixture_processed(spark, sf_dir, p))


def cleaning_job(typed: DataFrame, p: Params, path: str) -> dict[str, int]:
    """The batch cleaning job as one pass: clean, enrich and write Parquet to
    `path`, collecting the row audit (E22) with observations on the same job
    instead of separate count() actions over the input.

    Counts come from accumulators of the write job; a retried shuffle stage may
    add its rows again, so they are an audit, not a reconciliation total."""
    o_in, o_dedup, o_out = (Observation("raw"), Observation("deduplicated"),
                            Observation("clean"))
    crit = critical_null([c for c in CRITICAL_COLUMNS if c in typed.columns])
    src = typed.observe(o_in, F.count(F.lit(1)).alias("rows"),
                        F.count_if(crit).alias("null_critical"))
    d = deduplicated(src).observe(o_dedup, F.count(F.lit(1)).alias("rows"))
    kept = d.filter(valid_values() & in_window(p))
    out = enrich(kept, p).observe(o_out, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(path)
    raw = o_in.get
    audit = {"raw_rows": raw["rows"], "non_null_rows": raw["rows"] - raw["null_critical"],
             "deduplicated_rows": o_dedup.get["rows"], "clean_rows": o_out.get["rows"]}
    audit["removed_rows"] = audit["raw_rows"] - audit["clean_rows"]
    return audit
