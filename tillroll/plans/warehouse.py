"""Named layers in the session catalog.

`<prefix>_raw.transactions` is declared with DDL (column and table comments) as an
external Parquet table partitioned by year and month; staging is a temporary
view; the models are tables in `<prefix>_analytics` and `<prefix>_marts`. The prefix is
the caller's, so two deployments never share a table and nobody's `raw` or `marts` is
touched. Publishing replaces whole tables. The models are bucketed and sorted on
shop_id, so aggregates and joins by shop read them without an exchange. All data lives under a root folder in the
shared checkpoint location, so nothing is written to the process's working directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import cents_to_amount
from ..operators.materialize import shuffles_given_up
from ..sources.files import read_processed
from ..sources.schema import PROCESSED_SCHEMA
from .models import ModelSet
from .staging import stg_transactions

LAYERS = {
    "raw": "Clean sale lines as loaded from the processed files",
    "analytics": "Daily and product aggregates",
    "marts": "Tables that reports and dashboards read",
}


def _ddl_type(t: T.DataType) -> str:
    return t.simpleString().upper()


def transactions_ddl(table: str, location: str) -> str:
    part = {"year", "month_number"}
    cols = [f for f in PROCESSED_SCHEMA.fields if f.name not in part] + \
        [f for f in PROCESSED_SCHEMA.fields if f.name in part]
    body = ",\n  ".join(
        f"`{f.name}` {_ddl_type(f.dataType)} COMMENT '{f.metadata.get('comment', '')}'"
        for f in cols)
    return (f"CREATE TABLE {table} (\n  {body}\n) USING parquet\n"
            f"PARTITIONED BY (year, month_number)\nLOCATION '{location}'\n"
            f"COMMENT 'Clean sale lines'")


class Warehouse:
    """The layers of one deployment: databases `<prefix>_raw`, `_analytics`, `_marts`."""

    def __init__(self, spark: SparkSession, prefix: str, root: str, buckets: int | None = None):
        """`buckets` of the model tables: the shuffle partitions of the session unless
        given. A shop has one row a day or product in them, so no bucket is hot."""
        self.spark, self.prefix, self.root = spark, prefix, root
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}_{layer}.{table}"

    def publish(self, ms: ModelSet) -> "Warehouse":
        """Replaces every table. Processed rows are range-clustered by month, so a month
        folder gets a file or two, not one from every task. What `ms` had not written before
        it reads from the named tables afterwards, so nothing is kept twice."""
        spark, root = self.spark, self.root
        ms.forget_below(root)
        for layer, comment in LAYERS.items():
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}_{layer} "
                      f"COMMENT '{comment}' LOCATION '{root}/{layer}.db'")
        transactions = self.name("raw", "transactions")
        spark.sql(f"DROP TABLE IF EXISTS {transactions}")
        spark.sql(transactions_ddl(transactions, f"{root}/raw.db/transactions"))
        own = ms.missing()
        loaded = ms.processed().schema
        dealt = (ms.processed().select(*spark.table(transactions).columns)
                 .repartitionByRange("year", "month_number", "date", "transaction_id"))
        with shuffles_given_up(spark):
            dealt.write.insertInto(transactions, overwrite=True)
        if "processed" in own:
            ms.replace("processed", read_processed(
                spark, f"{root}/raw.db/transactions", loaded).select(*loaded.names))
        self.staging().createOrReplaceTempView(f"{self.prefix}_stg_transactions")

        def by_bucket(rows: DataFrame) -> DataFrame:
            # partitioned as the buckets are: one file each
            return rows.repartition(self.buckets, "shop_id")

        for layer, table, rows in (("analytics", "top_products", lambda: by_bucket(ms.top())),
                                   ("marts", "shop_performance", lambda: by_bucket(ms.shop())),
                                   ("analytics", "daily_revenue", lambda: ms.daily_dealt(by_bucket))):
            spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")
            path, df = f"{root}/{layer}.db/{table}", rows()
            with shuffles_given_up(spark):
                (df.write.bucketBy(self.buckets, "shop_id").sortBy("shop_id")
                 .option("path", path).saveAsTable(self.name(layer, table)))
            if table in own:
                ms.replace(table, spark.read.parquet(path).select(*df.columns))
            if table == "shop_performance" and "product_aggregates" in own:
                ms.replace("product_aggregates")  # both models that start from it are written
        return self

    def source(self, layer: str, table: str) -> DataFrame:
        """A named source table of the catalog."""
        return self.spark.table(self.name(layer, table))

    def shop_reconciliation(self) -> DataFrame:
        """Per shop its revenue by days, by products and in the shop mart, from the three
        bucketed tables: no exchange of any of them."""
        def total(layer: str, table: str, name: str) -> DataFrame:
            return self.source(layer, table).groupBy("shop_id").agg(
                F.sum("revenue_cents").alias(f"_{name}"), F.count(F.lit(1)).alias(name))

        shops = self.source("marts", "shop_performance").select("shop_id", "revenue_cents")
        return (shops.join(total("analytics", "daily_revenue", "days"), "shop_id")
                .join(total("analytics", "top_products", "products"), "shop_id")
                .select("shop_id", "days", "products",
                        cents_to_amount("revenue_cents").alias("shop_revenue"),
                        cents_to_amount("_days").alias("revenue_by_day"),
                        cents_to_amount("_products").alias("revenue_by_product")))

    def staging(self) -> DataFrame:
        return stg_transactions(self.source("raw", "transactions"))

    def columns(self, layer: str, table: str) -> DataFrame:
        """(column_name, data_type, comment) of a table as the catalog has them."""
        about = self.spark.sql(f"DESCRIBE TABLE {self.name(layer, table)}")
        # partition columns are listed again under headings that start with '#'
        return about.filter("col_name <> '' AND col_name NOT LIKE '#%'").distinct().selectExpr(
            "col_name AS column_name", "data_type", "comment")
