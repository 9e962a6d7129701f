"""The three models built on staging: daily_revenue, top_products, shop_performance.

Money is summed as BIGINT cents; rounded averages and percentages are integer
half-up divisions (see functions.money), so results do not depend on the order
in which partial sums are combined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.money import (avg_amount, cents_to_amount, pct_2dp, ratio_amount,
                               to_cents)
from ..operators.materialize import written
from ..operators.ranking import grand_total, ranked, ranks, same_as

DAILY_KEYS = ["transaction_date", "shop_id", "shop_name", "city", "day_of_week",
              "day_type", "australian_season", "month_name", "month_number", "year",
              "is_weekend"]
DAY_KEYS = ["transaction_date", "shop_id", "shop_name", "city"]
PRODUCT_KEYS = ["shop_id", "shop_name", "city", "product_name", "category"]
SHOP_KEYS = ["shop_id", "shop_name", "city"]
#: what `product_aggregates` reads beside its keys
PRODUCT_VALUES = ["transaction_id", "quantity", "total_cents", "unit_price", "is_weekend"]



def _weekend():
    return F.col("is_weekend") == F.lit(True)


def _weekday():
    return F.col("is_weekend") == F.lit(False)


def daily_revenue(stg: DataFrame, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per (date, shop) with revenue, counts, extremes and mix.

    The reference groups by eleven columns; seven of them (weekday, day type,
    season, month name and number, year, weekend flag) are functions of the date
    in the processed table, so the shuffle key is (date, shop_id, shop_name,
    city) and those seven are derived once per output row after the aggregate.

    See `day_sums` for the two distinct counts. `deal`, if given, deals the sums out anew
    before the columns are derived."""
    sums = day_sums(stg)
    return day_columns(deal(sums) if deal else sums)


def day_sums(stg: DataFrame, by: list[str] | None = None, *more: Column) -> DataFrame:
    """Sums and distinct counts per (date, shop); `more` aggregates may read
    `new_customer`, each distinct customer once.

    Days of a shop have few sales, so no partial aggregate shrinks the rows and every
    exchange costs as much as the table. There is one: rows are dealt by the group's keys
    (by ranges of the columns `by`, which the date and the shop determine, if given),
    after which grouping by (day, product, customer), marking the first row of every
    product and customer by sorted windows, and adding up stay where they are. The
    windows stream through sorts that may spill; none holds a group in memory."""
    keys = [*DAY_KEYS, *[c for c in by or [] if c not in DAY_KEYS]]
    rows = stg.select(
        *keys, "product_name", "customer_id", "total_cents",
        F.col("transaction_id").isNotNull().alias("_tx"),
        (F.col("payment_method") == "cash").alias("_cash"),
        (F.col("payment_method") == "card").alias("_card"))
    rows = rows.repartitionByRange(*by) if by else rows.repartition(*keys)
    sums = rows.groupBy(*keys, "product_name", "customer_id").agg(
        F.sum("total_cents").alias("_sum"),
        F.count_if("_tx").alias("_tx"),
        F.count("total_cents").alias("_n"),
        F.max("total_cents").alias("_max"),
        F.min("total_cents").alias("_min"),
        F.count_if("_cash").alias("_cash"),
        F.count_if("_card").alias("_card"),
    )

    def first(col: str, other: str) -> Column:
        place = F.row_number().over(Window.partitionBy(*keys, col).orderBy(other))
        return F.when(place == 1, F.col(col))

    marked = (sums.withColumn("new_product", first("product_name", "customer_id"))
              .withColumn("new_customer", first("customer_id", "product_name")))
    return marked.groupBy(*keys).agg(
        F.sum("_sum").alias("_sum"),
        F.sum("_tx").alias("total_transactions"),
        F.sum("_n").alias("_n"),
        F.max("_max").alias("_max"),
        F.min("_min").alias("_min"),
        F.count("new_product").alias("unique_products_sold"),
        F.count("new_customer").alias("unique_customers"),
        F.sum("_cash").alias("cash_transactions"),
        F.sum("_card").alias("card_transactions"), *more,
    )


def day_columns(g: DataFrame, *more: str) -> DataFrame:
    """The mart's columns from the sums per (date, shop) and `unique_customers`; `more`
    columns of `g` are kept."""
    d = F.col("transaction_date")
    weekend = cal.is_weekend(d)
    return g.select(
        "transaction_date", "shop_id", "shop_name", "city",
        cal.day_name(d).alias("day_of_week"),
        cal.day_type(weekend).alias("day_type"),
        cal.australian_season(d).alias("australian_season"),
        cal.month_name(d).alias("month_name"),
        F.month(d).alias("month_number"),
        F.year(d).alias("year"),
        weekend.alias("is_weekend"),
        cents_to_amount("_sum").alias("daily_revenue"),
        "total_transactions",
        avg_amount("_sum", "_n").alias("avg_transaction_value"),
        cents_to_amount("_max").alias("max_transaction_value"),
        cents_to_amount("_min").alias("min_transaction_value"),
        "unique_products_sold", "unique_customers",
        "cash_transactions", "card_transactions",
        F.current_timestamp().alias("updated_at"),
        F.col("_sum").alias("revenue_cents"), *more,
    )


def product_aggregates(stg: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(shop, product) grain sums before the per-shop ranks; per `by` too, if given."""
    return stg.groupBy(*PRODUCT_KEYS, *(by or [])).agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("quantity").cast("bigint").alias("total_units_sold"),
        F.sum("total_cents").alias("_sum"),
        F.count("total_cents").alias("_n"),
        F.sum(to_cents("unit_price")).alias("_price_sum"),
        F.count("unit_price").alias("_price_n"),
        F.sum(F.when(_weekend(), F.col("total_cents")).otherwise(0)).alias("_we"),
        F.sum(F.when(_weekday(), F.col("total_cents")).otherwise(0)).alias("_wd"),
    )


def top_products(stg: DataFrame | None, products: DataFrame | None = None) -> DataFrame:
    """E2 + F1–F3: product metrics with two in-shop ranks and the share of the
    shop's revenue.

    `products` is the written (shop, product) aggregate, made here if not given. Both
    ranks are operators.ranking.ranked; the shop total is a shop-level aggregate joined
    back on shop_id. No shop's products are gathered in one task."""
    g = products if products is not None else written(
        product_aggregates(stg), "product_aggregates")
    totals = written(g.groupBy(F.col("shop_id").alias("_shop"))
                     .agg(F.sum("_sum").alias("_shop_sum")), "shop_totals")
    by_revenue = ranks(g, "_sum", "revenue_rank_in_shop", ["shop_id"])
    by_count = ranks(g, "total_transactions", "popularity_rank_in_shop", ["shop_id"]).select(
        F.col("_g0").alias("_g1"), F.col("_v").alias("_v1"), "popularity_rank_in_shop")
    out = (g.join(by_revenue, same_as([("shop_id", "_g0"), ("_sum", "_v")]))
           .join(by_count, same_as([("shop_id", "_g1"), ("total_transactions", "_v1")]))
           .join(totals, same_as([("shop_id", "_shop")])))
    return out.select(
        *PRODUCT_KEYS,
        "total_transactions", "total_units_sold",
        cents_to_amount("_sum").alias("total_revenue"),
        avg_amount("_sum", "_n").alias("avg_sale_value"),
        avg_amount("_price_sum", "_price_n").alias("avg_unit_price"),
        "revenue_rank_in_shop", "popularity_rank_in_shop",
        cents_to_amount("_we").alias("weekend_revenue"),
        cents_to_amount("_wd").alias("weekday_revenue"),
        pct_2dp(F.col("_sum"), F.col("_shop_sum")).alias("pct_of_shop_revenue"),
        F.current_timestamp().alias("updated_at"),
        F.col("_sum").alias("revenue_cents"),
    )


def shop_aggregates(stg: DataFrame, products: DataFrame) -> DataFrame:
    """Shop-grain sums and counts.

    A COUNT DISTINCT beside the sums would carry all of them through the exchange once
    per shop and customer, which is nearly once per row, so customers are counted on rows
    of the shop keys and the customer alone; the sums are a row per shop and task. Distinct
    products and categories per shop are counted on `products`, the written (shop, product,
    category) aggregate — an exact coarsening, since every staging row belongs to one of
    its groups. All are joined on the shop keys."""
    g = with_counts(stg.groupBy(*SHOP_KEYS).agg(*shop_sums()), stg, "customer_id", "unique_customers")
    return with_product_counts(g, products)


def with_counts(g: DataFrame, rows: DataFrame, col: str, name: str) -> DataFrame:
    """`g`, a table by SHOP_KEYS, with the number of distinct `col` in every shop's `rows`."""
    keys = {c: f"_{name}_{c}" for c in SHOP_KEYS}
    n = rows.groupBy(*[F.col(c).alias(k) for c, k in keys.items()]).agg(F.countDistinct(col).alias(name))
    return g.join(n, same_as(list(keys.items())), "left").select(
        *g.columns, F.coalesce(name, F.lit(0)).alias(name))


def shop_sums() -> list[Column]:
    """The shop mart's sums and counts over staging rows; all merge by sum, but the
    extremes."""
    return [
        F.sum("total_cents").alias("_sum"),
        F.count("transaction_id").alias("total_transactions"),
        F.count("total_cents").alias("_n"),
        F.max("total_cents").alias("_max"),
        F.min("total_cents").alias("_min"),
        F.sum(F.when(_weekend(), F.col("total_cents")).otherwise(0)).alias("_we"),
        F.sum(F.when(_weekday(), F.col("total_cents")).otherwise(0)).alias("_wd"),
        F.count_if(_weekend()).alias("weekend_transactions"),
        F.count_if(_weekday()).alias("weekday_transactions"),
        F.count_if(F.col("payment_method") == "cash").alias("cash_transactions"),
        F.count_if(F.col("payment_method") == "card").alias("card_transactions"),
        F.count_if(F.col("revenue_category") == "High").alias("high_value_transactions"),
        F.count_if(F.col("revenue_category") == "Medium").alias("medium_value_transactions"),
        F.count_if(F.col("revenue_category") == "Low").alias("low_value_transactions"),
    ]


def with_product_counts(g: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct products and categories of every shop from the (shop, product) table."""
    for col, name in (("product_name", "unique_products"), ("category", "unique_categories")):
        g = with_counts(g, products, col, name)
    return g


SHOP_PERFORMANCE_COLUMNS = [
    "shop_id", "shop_name", "city", "total_revenue", "total_transactions",
    "avg_transaction_value", "highest_sale", "lowest_sale", "unique_customers",
    "revenue_per_customer", "unique_products", "unique_categories",
    "weekend_revenue", "weekday_revenue", "weekend_transactions",
    "weekday_transactions", "cash_transactions", "card_transactions",
    "card_payment_pct", "high_value_transactions", "medium_value_transactions",
    "low_value_transactions", "revenue_rank", "pct_of_total_revenue",
]


def shop_performance(stg: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """E3 + F4/F5: the shop mart. `products` is the written (shop, product) aggregate,
    made here if not given. The shop aggregate is written once: the rank and the grand
    total (a scalar subquery, bound to a column because the half-up helper names its
    divisor several times) read that table. No step gathers all shops into one task."""
    if products is None:
        products = written(product_aggregates(stg), "product_aggregates")
    return shop_columns(written(shop_aggregates(stg, products), "shop_aggregates"))


def shop_columns(g: DataFrame) -> DataFrame:
    """The mart's columns from the written shop aggregate."""
    g = ranked(g, "_sum", "revenue_rank").withColumn("_total", grand_total(g, "_sum"))
    m = g.select(
        *SHOP_KEYS,
        cents_to_amount("_sum").alias("total_revenue"),
        "total_transactions",
        avg_amount("_sum", "_n").alias("avg_transaction_value"),
        cents_to_amount("_max").alias("highest_sale"),
        cents_to_amount("_min").alias("lowest_sale"),
        "unique_customers",
        ratio_amount("_sum", "unique_customers").alias("revenue_per_customer"),
        "unique_products", "unique_categories",
        cents_to_amount("_we").alias("weekend_revenue"),
        cents_to_amount("_wd").alias("weekday_revenue"),
        "weekend_transactions", "weekday_transactions",
        "cash_transactions", "card_transactions",
        pct_2dp("card_transactions", "total_transactions").alias("card_payment_pct"),
        "high_value_transactions", "medium_value_transactions", "low_value_transactions",
        pct_2dp(F.col("_sum"), F.col("_total")).alias("pct_of_total_revenue"),
        F.col("_sum").alias("revenue_cents"), "revenue_rank",
    )
    return m.select(*SHOP_PERFORMANCE_COLUMNS[:-2], "revenue_rank",
                    "pct_of_total_revenue",
                    F.current_timestamp().alias("updated_at"), "revenue_cents")
