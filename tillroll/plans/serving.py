"""Serving queries over the marts: each endpoint of the reference's API is a
function returning a lazy DataFrame; the caller collects or writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formatting as fmt
from ..functions.money import avg_amount, cents_to_amount, pct_0dp, pct_2dp, to_cents
from ..operators.ranking import grand_max, top_ranked

SHOP_LIST_COLUMNS = [
    "shop_id", "shop_name", "city", "total_revenue", "total_transactions",
    "avg_transaction_value", "unique_customers", "revenue_per_customer",
    "weekend_revenue", "weekday_revenue", "card_payment_pct", "revenue_rank",
    "pct_of_total_revenue",
]

# The dashboard's weekday display order.
WEEKDAY_DISPLAY_ORDER = ["Saturday", "Sunday", "Wednesday", "Friday", "Tuesday",
                         "Thursday", "Monday"]


def shops(shop_mart: DataFrame) -> DataFrame:
    """V1 `/shops`: 13 columns, by revenue rank."""
    return shop_mart.select(*SHOP_LIST_COLUMNS).orderBy("revenue_rank", "shop_id")


REPORT_SHOP_COLUMNS = [
    "shop_name", "city", "total_revenue", "total_transactions", "avg_transaction_value",
    "unique_customers", "revenue_per_customer", "weekend_revenue", "weekday_revenue",
    "card_payment_pct", "high_value_transactions", "medium_value_transactions",
    "low_value_transactions", "revenue_rank", "pct_of_total_revenue",
]


def report_shops(shop_mart: DataFrame) -> DataFrame:
    """V8: the report loader's wide shop list (15 columns), by revenue rank."""
    return shop_mart.select(*REPORT_SHOP_COLUMNS).orderBy("revenue_rank", "shop_name")


def shop_by_id(shop_mart: DataFrame, shop_id: str) -> DataFrame:
    """V2 `/shops/{id}`: case-folded point lookup; an empty result means not found.
    The argument is a bound literal, never spliced into SQL text: `x' OR '1'='1` is
    compared as text."""
    return shop_mart.filter(F.col("shop_id") == F.upper(F.lit(shop_id)))


def recent_daily(daily: DataFrame, limit: int = 100) -> DataFrame:
    """V3 `/revenue/daily`: the latest `limit` shop-days; shop_id breaks date ties
    so the answer is deterministic (distributed top-k, no global sort)."""
    return (daily.select("transaction_date", "shop_id", "shop_name", "daily_revenue",
                         "total_transactions", "avg_transaction_value", "day_of_week",
                         "is_weekend")
            .orderBy(F.desc("transaction_date"), "shop_id").limit(limit))


def weekday_stats(daily: DataFrame) -> DataFrame:
    """Aggregate of aggregates: per weekday name, the sums and row counts of the
    (shop, day) rows of `daily_revenue`. Days without sales are absent there, so
    the mean skips them (the gap-filled mean is in metrics.calendar_spine)."""
    cents = (F.col("revenue_cents") if "revenue_cents" in daily.columns
             else to_cents("daily_revenue"))
    return daily.groupBy("day_of_week").agg(
        F.sum(cents).alias("_s"), F.count(cents).alias("_n"),
        F.sum("total_transactions").cast("bigint").alias("total_transactions"))


def revenue_by_weekday(daily: DataFrame) -> DataFrame:
    """V4 `/revenue/by-day` (E6): mean and total daily revenue per weekday."""
    g = weekday_stats(daily)
    return g.select("day_of_week",
                    avg_amount("_s", "_n").alias("avg_revenue"),
                    cents_to_amount("_s").alias("total_revenue"),
                    "total_transactions").orderBy(F.desc("avg_revenue"))


def weekday_dimension(spark: SparkSession) -> DataFrame:
    """The seven weekday names with their display position (fixed, 7 rows)."""
    return spark.createDataFrame(
        [(d, i + 1) for i, d in enumerate(WEEKDAY_DISPLAY_ORDER)],
        "day_of_week string, display_order int")


def weekday_reindexed(daily: DataFrame) -> DataFrame:
    """D1 + G7: weekday means in display order; a weekday without rows shows 0.
    Both sides have at most seven rows, so the join is broadcast."""
    stats = revenue_by_weekday(daily).select("day_of_week", "avg_revenue")
    dim = weekday_dimension(daily.sparkSession)
    return (dim.join(F.broadcast(stats), "day_of_week", "left")
            .select("day_of_week", "display_order",
                    F.coalesce("avg_revenue", F.lit(0.0)).alias("avg_revenue"))
            .orderBy("display_order"))


PRODUCT_LIST_COLUMNS = ["shop_name", "product_name", "category", "total_revenue",
                        "total_units_sold", "avg_sale_value", "revenue_rank_in_shop",
                        "pct_of_shop_revenue"]


def top_products_per_shop(top: DataFrame, k: int = 5) -> DataFrame:
    """V5 `/products` (k=5) and the report loader (k=3): rank threshold, so ties
    may return more than k rows per shop."""
    return (top.filter(F.col("revenue_rank_in_shop") <= k)
            .select(*PRODUCT_LIST_COLUMNS)
            .orderBy("shop_name", "revenue_rank_in_shop", "product_name"))


def top_products_from_sums(products: DataFrame, k: int = 5) -> DataFrame:
    """G6 + C7: the same list straight from the written (shop, product) aggregate, for
    when the product mart is not built: only each shop's k first revenues are ranked."""
    totals = products.groupBy(F.col("shop_id").alias("_shop")).agg(F.sum("_sum").alias("_shop_sum"))
    first = top_ranked(products, "_sum", "revenue_rank_in_shop", k, ["shop_id"])
    return first.join(totals, F.col("shop_id").eqNullSafe(F.col("_shop"))).select(
        "shop_name", "product_name", "category", cents_to_amount("_sum").alias("total_revenue"),
        "total_units_sold", avg_amount("_sum", "_n").alias("avg_sale_value"), "revenue_rank_in_shop",
        pct_2dp(F.col("_sum"), F.col("_shop_sum")).alias("pct_of_shop_revenue"))


def portfolio_summary(shop_mart: DataFrame) -> DataFrame:
    """V7 `/summary` exactly as defined: sums over the shop rows, so customers
    shared by shops are counted once per shop and the average is a mean of
    per-shop means."""
    return shop_mart.agg(
        F.count(F.lit(1)).alias("total_shops"),
        F.sum(to_cents("total_revenue")).alias("_s"),
        F.sum("total_transactions").cast("bigint").alias("total_transactions"),
        F.sum(to_cents("avg_transaction_value")).alias("_a"),
        F.count("avg_transaction_value").alias("_an"),
        F.sum("unique_customers").cast("bigint").alias("total_customers"),
    ).select("total_shops", cents_to_amount("_s").alias("total_revenue"),
             "total_transactions", avg_amount("_a", "_an").alias("avg_transaction_value"),
             "total_customers")


def portfolio_summary_true(stg: DataFrame, shop_mart: DataFrame) -> DataFrame:
    """The same figures without counting shared customers twice: the shop mart's sums
    (its rows partition the transactions) beside the distinct customers of all shops,
    for which staging is read in that one column."""
    customers = stg.select(F.countDistinct("customer_id")).scalar()
    return shop_mart.agg(
        F.countDistinct("shop_id").alias("total_shops"),
        F.sum("revenue_cents").alias("_s"),
        F.sum("total_transactions").cast("bigint").alias("total_transactions"),
    ).select("total_shops", cents_to_amount("_s").alias("total_revenue"),
             "total_transactions",
             avg_amount("_s", "total_transactions").alias("avg_transaction_value"),
             customers.alias("total_customers"))


def shop_bars(shop_mart: DataFrame) -> DataFrame:
    """F6 + F7: bar width as whole percent of the top revenue, and a rank badge.
    The maximum is a scalar subquery (one value), not a global window."""
    cents = to_cents("total_revenue")
    top = grand_max(shop_mart.select(cents.alias("_c")), "_c")
    return shop_mart.withColumn("_top", top).select(
        "shop_id", "shop_name", "total_revenue", "revenue_rank",
        pct_0dp(cents, F.col("_top")).alias("bar_pct"),
        F.when(F.col("revenue_rank") <= 3,
               F.concat(F.lit("rank-"), F.col("revenue_rank").cast("string")))
         .otherwise("rank-other").alias("badge_class"))


def formatted_shops(shop_mart: DataFrame) -> DataFrame:
    """The dashboard's display strings for each shop."""
    return shop_mart.select(
        "shop_id",
        fmt.first_space_to_newline("shop_name").alias("chart_label"),
        fmt.currency_0dp(to_cents("total_revenue")).alias("revenue_text"),
        fmt.thousands("total_transactions").alias("transactions_text"),
        fmt.currency_0dp(to_cents("avg_transaction_value")).alias("avg_sale_text"),
        fmt.thousands_label(to_cents("total_revenue")).alias("axis_label"),
        fmt.percent_1dp(to_cents("pct_of_total_revenue")).alias("share_text"))
