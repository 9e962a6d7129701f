"""Business metrics quoted in the reference's generated report (M1–M7), the
gap-filled calendar spine (D3) and seasonally adjusted revenue (B17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.money import (avg_amount, cents_to_amount, half_up_div, pct_2dp,
                               to_cents)
from ..operators.ranking import grand_max
from .serving import WEEKDAY_DISPLAY_ORDER, revenue_by_weekday


def value_mix(shop_mart: DataFrame) -> DataFrame:
    """M1: share of high / medium / low value transactions per shop (2 dp %)."""
    n = F.col("total_transactions")
    return shop_mart.select(
        "shop_id", "shop_name",
        pct_2dp("high_value_transactions", n).alias("high_value_pct"),
        pct_2dp("medium_value_transactions", n).alias("medium_value_pct"),
        pct_2dp("low_value_transactions", n).alias("low_value_pct"))


def weekend_share(shop_mart: DataFrame) -> DataFrame:
    """M2: weekend share of each shop's revenue and of its transactions."""
    return shop_mart.select(
        "shop_id", "shop_name",
        pct_2dp(to_cents("weekend_revenue"), to_cents("total_revenue"))
        .alias("weekend_revenue_pct"),
        pct_2dp("weekend_transactions", "total_transactions")
        .alias("weekend_transactions_pct"))


def peer_ratio(shop_mart: DataFrame) -> DataFrame:
    """M3: each shop's average sale relative to the highest shop average (2 dp).
    The maximum is one value from a scalar subquery."""
    avg_c = to_cents("avg_transaction_value")
    top = grand_max(shop_mart.select(avg_c.alias("_a")), "_a")
    return shop_mart.withColumn("_top", top).select(
        "shop_id", "shop_name", "avg_transaction_value",
        (half_up_div(avg_c, F.col("_top"), 100).cast("double") / 100)
        .alias("ratio_to_top_avg"))


def bottom_products(top: DataFrame) -> DataFrame:
    """M4: the lowest-revenue product(s) of each shop (ascending rank = 1).

    Rank 1 ascending (NULLs last) is "value equals the shop's minimum", or every
    row when the shop has no non-NULL value. So this is a per-shop MIN (partial
    aggregation, one row per shop) joined back on (shop, value) with a NULL-safe
    equality: the join key includes the value, so a shop holding most products
    is spread over many tasks, and no window or sort is needed."""
    base = top.select("shop_id", "shop_name", "product_name", "category",
                      "total_revenue", to_cents("total_revenue").alias("_c"))
    mins = base.groupBy(F.col("shop_id").alias("_s")).agg(F.min("_c").alias("_m"))
    cond = (F.col("shop_id") == F.col("_s")) & F.col("_c").eqNullSafe(F.col("_m"))
    return (base.join(mins, cond, "inner")
            .select("shop_id", "shop_name", "product_name", "category", "total_revenue"))


def top_products_overall(top: DataFrame, k: int = 5) -> DataFrame:
    """M5: products ranked over all shops, rank <= k (ties kept).

    A value's rank is at most k only if it is among the k largest distinct values; these
    are a distributed top-k over counted values (one row per value), and their ranks a
    running sum over k rows. The products are then those whose value is among them."""
    cents = to_cents("total_revenue")
    base = top.select("shop_id", "shop_name", "product_name", "category",
                      "total_revenue", cents.alias("_c"))
    best = (base.filter(F.col("_c").isNotNull()).groupBy(F.col("_c").alias("_v"))
            .agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_v")).limit(k))
    above = Window.orderBy(F.desc("_v")).rowsBetween(Window.unboundedPreceding, -1)
    best = best.select("_v", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).cast("int")
                       .alias("overall_rank")).filter(F.col("overall_rank") <= k)
    return (base.join(F.broadcast(best), F.col("_c") == F.col("_v"))
            .drop("_c", "_v"))


def customers_per_shop(shop_mart: DataFrame, stg: DataFrame) -> DataFrame:
    """M6: mean distinct customers per shop (2 dp) next to the distinct customers
    of all shops together (customers are shared between shops)."""
    per_shop = shop_mart.agg(F.sum("unique_customers").alias("_s"),
                             F.count("unique_customers").alias("_n"))
    distinct_all = stg.select(F.countDistinct("customer_id")).scalar()
    return per_shop.select(
        F.col("_n").alias("shops"),
        (half_up_div("_s", "_n", 100).cast("double") / 100)
        .alias("avg_customers_per_shop"),
        distinct_all.alias("distinct_customers"))


def insight_context(shop_mart: DataFrame, top: DataFrame, daily: DataFrame,
                    k: int = 3) -> DataFrame:
    """The report's data bundle as JSON, one row per item: (section, shop_id,
    position, json). Sections are `shop` (a shop's figures, position its revenue rank),
    `product` (a product with rank <= k in its shop, ties kept, position its rank) and
    `weekday` (a weekday's mean, no shop, position in display order). A consumer orders
    by section and position; no value's length follows the data."""
    def money(c: str):
        return F.col(c).cast("decimal(20,2)").alias(c)

    def items(df: DataFrame, section: str, shop, position, *fields) -> DataFrame:
        return df.select(F.lit(section).alias("section"), shop.cast("string").alias("shop_id"),
                         position.cast("int").alias("position"),
                         F.to_json(F.struct(*fields)).alias("json"))

    shops = items(shop_mart, "shop", F.col("shop_id"), F.col("revenue_rank"),
                  "shop_name", "city", money("total_revenue"), money("avg_transaction_value"),
                  "revenue_rank", money("pct_of_total_revenue"))
    products = items(top.filter(F.col("revenue_rank_in_shop") <= k), "product",
                     F.col("shop_id"), F.col("revenue_rank_in_shop"),
                     "product_name", "category", money("total_revenue"))
    order = F.array(*[F.lit(d) for d in WEEKDAY_DISPLAY_ORDER])
    days = items(revenue_by_weekday(daily), "weekday", F.lit(None),
                 F.array_position(order, F.col("day_of_week")), "day_of_week", money("avg_revenue"))
    return shops.unionByName(products).unionByName(days)


def date_bounds(daily: DataFrame):
    """struct(lo, hi): first and last day, one aggregate as one scalar subquery."""
    return daily.select(F.struct(F.min("transaction_date").alias("lo"),
                                 F.max("transaction_date").alias("hi"))).scalar()


def calendar_spine_daily(daily: DataFrame) -> DataFrame:
    """D3: every day between the first and last sale for every shop that sold,
    with zero revenue on days without sales.

    The spine is generated per shop (explode of a date sequence whose bounds are
    one scalar subquery), so it is spread evenly over the shop rows; no cross
    join. It is then left-joined to the daily rows on their unique key."""
    days = date_bounds(daily)
    shops = daily.select("shop_id").distinct()
    spine = shops.select("shop_id", F.explode(F.sequence(
        days["lo"], days["hi"], F.expr("INTERVAL 1 DAY"))).alias("transaction_date"))
    d = daily.select("shop_id", "transaction_date", "revenue_cents", "total_transactions")
    j = spine.join(d, ["shop_id", "transaction_date"], "left")
    return j.select(
        "transaction_date", "shop_id",
        cal.day_name("transaction_date").alias("day_of_week"),
        cents_to_amount(F.coalesce("revenue_cents", F.lit(0))).alias("daily_revenue"),
        F.coalesce("total_transactions", F.lit(0)).cast("bigint").alias("total_transactions"),
        F.coalesce("revenue_cents", F.lit(0)).alias("revenue_cents"))


def revenue_by_weekday_filled(daily: DataFrame) -> DataFrame:
    """E6 over all days of all shops: days without sales count as zero revenue. They add
    nothing to a weekday's sum, and its number of shop-days is the number of shops times
    its days between the bounds, so the shop x day grid is never made."""
    span = daily.agg(F.min("transaction_date").alias("lo"), F.max("transaction_date").alias("hi"),
                     F.countDistinct("shop_id").alias("shops"))
    days = (span.filter("lo IS NOT NULL")
            .select("shops", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
            .groupBy(cal.day_name("d").alias("day_of_week"))
            .agg((F.count(F.lit(1)) * F.max("shops")).alias("_n")))
    sums = daily.groupBy(F.col("day_of_week").alias("_day")).agg(F.sum("revenue_cents").alias("_s"))
    j = days.join(F.broadcast(sums), F.col("day_of_week") == F.col("_day"), "left")
    return j.select("day_of_week", avg_amount(F.coalesce("_s", F.lit(0)), "_n").alias("avg_revenue"),
                    F.col("_n").alias("shop_days"))


def seasonally_adjusted_daily(daily: DataFrame) -> DataFrame:
    """Daily revenue divided by the demand multiplier of its date
    (Saturday 1.4, Sunday 1.3, 15–31 Dec 1.8, April 1.2, multiplied), exact to
    the cent: half-up(1000 · cents / factor-in-thousandths)."""
    f = cal.demand_factor_thousandths("transaction_date")
    return daily.select(
        "transaction_date", "shop_id", "daily_revenue",
        (f.cast("double") / 1000).alias("demand_factor"),
        cents_to_amount(half_up_div("revenue_cents", f, 1000))
        .alias("adjusted_revenue"))
