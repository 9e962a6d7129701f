"""Incremental refresh of the marts.

A full build aggregates every staging row again. Here each month's partial aggregates
are kept as Parquet partitioned by (year, month_number), and a refresh computes anew only
the months that a load has touched:

* `days`: the finished daily_revenue rows of the month, with a customer sketch each;
* `products`: sums per (shop, product);
* `shops`: sums, counts and extremes per shop;
* `customers`: the distinct (shop, customer) pairs, because exact distinct counts do not
  add up.

A refresh reads the processed table through a filter on its partition columns, so only
the touched month folders are scanned, and replaces only their partitions: running it
twice changes nothing. A month that no longer has rows loses its partitions. daily_revenue
is read as it is; top_products and shop_performance merge the months' partials, which
have a row per shop, product or customer and month instead of one per sale.

**Sketches.** `customer_sketch` is a HyperLogLog sketch (Apache DataSketches, 2**LG_K
registers) per day and shop. Sketches merge without the sales they came from: over any
span of days and any set of shops `customers_approx` unions them. The relative standard
error is 1.04 / sqrt(2**LG_K), 1.6 %; up to some hundred customers counts are nearly exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import remove_folder, written
from ..operators.ranking import same_as
from ..sources.schema import PROCESSED_SCHEMA
from . import marts
from .staging import stg_transactions

LG_K = 12
ERROR = 1.04 / (1 << LG_K) ** 0.5
MONTH = ["year", "month_number"]
SHOP_EXTREMES = {"_max": F.max, "_min": F.min}


def touched_months(rows: DataFrame) -> list[tuple[int, int]]:
    """The (year, month) pairs of loaded processed rows: at most twelve a year."""
    return sorted(tuple(r) for r in rows.select(*MONTH).distinct().collect())


def in_months(months: list[tuple[int, int]]) -> Column:
    keep = F.lit(False)
    for year, month in months:
        keep = keep | ((F.col("year") == year) & (F.col("month_number") == month))
    return keep


def customers_approx(days: DataFrame, by: list[str | Column]) -> DataFrame:
    """Estimated distinct customers of each group of day rows, from their sketches."""
    return days.groupBy(*by).agg(F.hll_sketch_estimate(
        F.hll_union_agg("customer_sketch", F.lit(False))).alias("customers_approx"))


def partials(stg: DataFrame) -> dict[str, DataFrame]:
    """The partial tables of staging rows; every row belongs to one month. Each is dealt
    by ranges that begin with the month, so it is written as it lies. Days, products and
    customers of a month are nearly as many as its sales: their rows are dealt so before
    they are grouped, not once more after."""
    days = marts.day_sums(stg, [*MONTH, "transaction_date", "shop_id"],
                          F.hll_sketch_agg("new_customer", F.lit(LG_K)).alias("customer_sketch"))
    sold = stg.select(*marts.PRODUCT_KEYS, *MONTH, *marts.PRODUCT_VALUES)
    customers = stg.filter("customer_id IS NOT NULL").select(*marts.SHOP_KEYS, *MONTH, "customer_id")
    return {
        "days": marts.day_columns(days, "customer_sketch"),
        "products": marts.product_aggregates(
            sold.repartitionByRange(*MONTH, "shop_id", "product_name"), MONTH),
        "shops": stg.groupBy(*marts.SHOP_KEYS, *MONTH).agg(*marts.shop_sums())
        .repartitionByRange(*MONTH, "shop_id"),
        "customers": customers.repartitionByRange(*MONTH, "shop_id", "customer_id").distinct(),
    }


@dataclass
class IncrementalMarts:
    """The partial tables below `root` for the processed table at `processed`."""
    spark: SparkSession
    processed: str
    root: str

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _table(self, name: str) -> DataFrame:
        none = stg_transactions(self.spark.createDataFrame([], PROCESSED_SCHEMA))
        return self.spark.read.schema(partials(none)[name].schema).parquet(self._path(name))

    def staging(self, months: list[tuple[int, int]] | None = None) -> DataFrame:
        """Staging rows, of some months only: a partition filter on the processed table."""
        rows = self.spark.read.schema(PROCESSED_SCHEMA).parquet(self.processed)
        return stg_transactions(rows if months is None else rows.filter(in_months(months)))

    def refresh(self, months: list[tuple[int, int]] | None = None) -> "IncrementalMarts":
        """Computes the months anew (None: all there are) and replaces their partitions."""
        if months is not None and not months:
            return self
        tables = partials(self.staging(months))
        for name, df in tables.items():
            mode = "static" if months is None else "dynamic"
            (df.write.mode("overwrite").option("partitionOverwriteMode", mode)
             .partitionBy(*MONTH).parquet(self._path(name)))
        for year, month in self._gone(months or []):
            for name in tables:
                remove_folder(self.spark, f"{self._path(name)}/year={year}/month_number={month}")
        return self

    def _gone(self, months: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Those of `months` that have no staging rows any more."""
        if not months:
            return []
        there = set(touched_months(self.staging(months)))
        return [m for m in months if m not in there]

    # ---- the marts ----------------------------------------------------------------

    def days(self) -> DataFrame:
        return self._table("days")

    def daily_revenue(self) -> DataFrame:
        return self.days().drop("customer_sketch")

    def products(self) -> DataFrame:
        """The (shop, product) aggregate over all months."""
        p = self._table("products")
        sums = [c for c in p.columns if c not in (*marts.PRODUCT_KEYS, *MONTH)]
        return p.groupBy(*marts.PRODUCT_KEYS).agg(*[F.sum(c).alias(c) for c in sums])

    def top_products(self) -> DataFrame:
        return marts.top_products(None, written(self.products(), "product_aggregates"))

    def shop_performance(self) -> DataFrame:
        s = self._table("shops")
        sums = [c for c in s.columns if c not in (*marts.SHOP_KEYS, *MONTH)]
        g = s.groupBy(*marts.SHOP_KEYS).agg(*[SHOP_EXTREMES.get(c, F.sum)(c).alias(c) for c in sums])
        who = self._table("customers").groupBy(*[F.col(k).alias(f"_c_{k}") for k in marts.SHOP_KEYS]).agg(
            F.countDistinct("customer_id").alias("unique_customers"))
        g = g.join(who, same_as([(k, f"_c_{k}") for k in marts.SHOP_KEYS]), "left").select(
            *g.columns, F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"))
        products = written(self.products(), "product_aggregates")
        return marts.shop_columns(written(marts.with_product_counts(g, products), "shop_aggregates"))
