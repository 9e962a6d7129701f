"""Enrichment of clean transactions (the processed table's derived columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.money import to_cents
from ..params import Params

PROCESSED_COLUMNS = [
    "transaction_id", "date", "time", "shop_id", "shop_name", "city",
    "product_name", "category", "quantity", "unit_price", "total_amount",
    "customer_id", "payment_method", "day_of_week", "month_name", "year",
    "month_number", "is_weekend", "revenue_category", "processed_timestamp",
    "total_cents",
]


def enrich(clean_df: DataFrame, p: Params) -> DataFrame:
    """Weekday and month names, year, month, weekend flag, revenue band,
    load timestamp and the amount in cents. The band is that of the delivered amount:
    19.996 is below 20."""
    d = F.col("date")
    return clean_df.select(
        "transaction_id", "date", "time", "shop_id", "shop_name", "city",
        "product_name", "category", "quantity", "unit_price",
        "total_amount", "customer_id", "payment_method",
        cal.day_name(d).alias("day_of_week"),
        cal.month_name(d).alias("month_name"),
        F.year(d).alias("year"),
        F.month(d).alias("month_number"),
        cal.is_weekend(d).alias("is_weekend"),
        cal.revenue_category("total_amount", p.low_below, p.medium_below)
           .alias("revenue_category"),
        F.current_timestamp().alias("processed_timestamp"),
        to_cents("total_amount").alias("total_cents"),
    )
