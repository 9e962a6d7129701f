"""Shop transactions derived from the driver's star-schema tables.

lineitem ⋈ orders ⋈ part ⋈ (supplier ⋈ nation) gives one transaction per line:
the supplier plays the shop, its nation the city, the part the product, the
order's customer the customer. All joins are inner equi-joins; the optimizer
chooses broadcast (small dimension, by its checked size estimate) or sort-merge
(large one) per side, and only the needed columns are read from each table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formatting import padded_id
from ..functions.money import to_cents
from .schema import RAW_COLUMNS, TYPED_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _two_digits(c):
    return F.lpad(c.cast("string"), 2, "0")


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop dimension: supplier with its nation as city."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .select(F.col("s_suppkey"),
                    padded_id("SHOP", "s_suppkey").alias("shop_id"),
                    F.col("s_name").alias("shop_name"),
                    F.col("n_name").alias("city")))


#: the order key beside the typed columns, for `dealt_transactions`
ORDER_KEY = "_order"


def typed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions (TYPED_SCHEMA), duplicates included."""
    return _transactions(spark, sf_dir, orders_last=False).select(*[f.name for f in TYPED_SCHEMA.fields])


def dealt_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with ORDER_KEY, which the transaction id holds. Orders are joined
    last, so the rows lie dealt by that key: a grouping by it and the id needs no further
    exchange of the widened rows."""
    return _transactions(spark, sf_dir, orders_last=True)


def _transactions(spark: SparkSession, sf_dir: str, orders_last: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice")
    if not orders_last:
        li = li.repartition("l_orderkey")  # the key of the largest join
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type",
                                            "p_retailprice")
    # Each dimension joins the fact rows as a base table, so the planner's
    # broadcast decision uses that table's real size (a pre-joined
    # supplier ⋈ nation is estimated as the product of both and never broadcast).
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li if orders_last else li.join(od, li.l_orderkey == od.o_orderkey)
    j = (j.join(pt, li.l_partkey == pt.p_partkey)
         .join(sup, li.l_suppkey == sup.s_suppkey)
         .join(nat, sup.s_nationkey == nat.n_nationkey))
    if orders_last:
        j = j.join(od, li.l_orderkey == od.o_orderkey)
    j = (j.withColumn("shop_id", padded_id("SHOP", "s_suppkey"))
         .withColumnRenamed("s_name", "shop_name")
         .withColumnRenamed("n_name", "city"))
    return j.select(
        F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.concat_ws(":", _two_digits(F.col("o_orderkey") % 24),
                    _two_digits(F.col("l_linenumber") * 13 % 60)).alias("time"),
        "shop_id", "shop_name", "city",
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_extendedprice").cast("double").alias("total_amount"),
        padded_id("CUST", "o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 4 == 1, "cash").otherwise("card")
         .alias("payment_method"),
        F.col("l_orderkey").alias(ORDER_KEY),
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture with deterministic defects, each keyed on the line's cents: NULL date
    or product, zero quantity, negative amount, an amount below a cent, an amount that
    rounds up into the next band, and an id with a blank before it."""
    return _with_defects(typed_transactions(spark, sf_dir)).drop("_c")


def _with_defects(t: DataFrame) -> DataFrame:
    c, amount = F.col("_c"), F.col("total_amount")
    return t.withColumn("_c", to_cents("total_amount")).select(
        F.when(c % 131 == 0, F.concat(F.lit(" "), F.col("transaction_id")))
         .otherwise(F.col("transaction_id")).alias("transaction_id"),
        F.when(c % 101 == 0, F.lit(None)).otherwise(F.col("date")).alias("date"),
        "time", "shop_id", "shop_name", "city",
        F.when(c % 103 == 0, F.lit(None)).otherwise(F.col("product_name"))
         .alias("product_name"),
        "category",
        F.when(c % 107 == 0, F.lit(0)).otherwise(F.col("quantity")).alias("quantity"),
        "unit_price",
        F.when(c % 109 == 0, -amount).when(c % 113 == 0, 0.004)
         .when(c % 127 == 0, 19999.996).otherwise(amount).alias("total_amount"),
        "customer_id", "payment_method", "_c",
    )


def raw_text_transactions(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """The fixture rendered as the raw CSV text columns (13 strings)."""
    t = dirty_transactions(spark, sf_dir) if dirty else typed_transactions(spark, sf_dir)
    return _as_text(t)


def _as_text(t: DataFrame) -> DataFrame:
    rest = [c for c in t.columns if c not in RAW_COLUMNS]
    return t.withColumn("date", F.date_format("date", "yyyy-MM-dd")).select(
        *[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS], *rest)


#: header texts as a shop's export might have them
MESSY_HEADERS = {"transaction_id": "Transaction ID", "unit_price": " Unit Price ",
                 "shop_name": "SHOP_NAME", "payment_method": "Payment Method",
                 "date": "Date ", "time": " time"}


def messy_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty fixture as raw text under messy headers, with dates in another form,
    quantities that are no numbers, and lines with too many fields (an unquoted comma in
    the last column)."""
    t = _as_text(_with_defects(typed_transactions(spark, sf_dir)))
    c = F.col("_c")
    t = (t.withColumn("date", F.when(c % 137 == 0, "31/12/1999").otherwise(F.col("date")))
         .withColumn("quantity", F.when(c % 139 == 0, "many").otherwise(F.col("quantity")))
         .withColumn("payment_method", F.when(c % 149 == 0, F.concat(
             F.col("payment_method"), F.lit(",oops,more"))).otherwise(F.col("payment_method"))))
    return t.select(*[F.col(n).alias(MESSY_HEADERS.get(n, n)) for n in RAW_COLUMNS])
