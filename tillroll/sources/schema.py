"""Explicit schemas with column documentation (no schema inference on read)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _f(name, dtype, comment, nullable=True):
    return T.StructField(name, dtype, nullable, metadata={"comment": comment})


# What each column holds, in one place; every schema takes its comments from here.
DOCS = {
    "transaction_id": "Key of one sale line; repeated keys are duplicates",
    "date": "Day of the sale (raw files: yyyy-MM-dd)",
    "time": "Clock time as text, e.g. 09:15",
    "shop_id": "Key of the shop, e.g. SHOP000007",
    "shop_name": "Name shown for the shop",
    "city": "Where the shop is",
    "product_name": "What was sold",
    "category": "Group the product belongs to",
    "quantity": "Number of units on the line",
    "unit_price": "Price of one unit",
    "total_amount": "Amount of the line as delivered, not rounded",
    "customer_id": "Key of the buyer",
    "payment_method": "How it was paid: cash or card",
    "day_of_week": "English weekday of the sale",
    "month_name": "English month of the sale",
    "year": "Year of the sale",
    "month_number": "Month of the sale, 1 to 12",
    "is_weekend": "True on Saturday and Sunday",
    "revenue_category": "Band of the line amount: Low, Medium or High",
    "processed_timestamp": "When the cleaning job wrote the row",
    "total_cents": "Amount of the line in whole cents",
    "_corrupt_record": "A raw line that does not fit the header",
}


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([_f(name, dtype, DOCS[name]) for name, dtype in columns.items()])


# Raw shop CSV: every column is read as text so that a bad value becomes NULL in
# the typed step instead of failing the read or changing a column's type; `time`
# ("09:15") must stay a string.
RAW_COLUMNS = ["transaction_id", "date", "time", "shop_id", "shop_name", "city",
               "product_name", "category", "quantity", "unit_price", "total_amount",
               "customer_id", "payment_method"]
RAW_SCHEMA = _schema(**{c: _S for c in RAW_COLUMNS})
RAW_SCHEMA_WITH_CORRUPT = _schema(**{c: _S for c in [*RAW_COLUMNS, "_corrupt_record"]})

# Typed transactions, the common input of cleaning (CSV after parsing, or the
# star-schema fixture). Amounts are as delivered; cents are taken after cleaning.
TYPED_SCHEMA = _schema(
    transaction_id=_S, date=T.DateType(), time=_S, shop_id=_S, shop_name=_S, city=_S,
    product_name=_S, category=_S, quantity=_I, unit_price=_D, total_amount=_D,
    customer_id=_S, payment_method=_S)

# Processed transactions (warehouse table `transactions`), 20 columns plus the
# cents column that all money sums use.
PROCESSED_SCHEMA = _schema(
    transaction_id=_S, date=T.DateType(), time=_S, shop_id=_S, shop_name=_S, city=_S,
    product_name=_S, category=_S, quantity=_I, unit_price=_D, total_amount=_D,
    customer_id=_S, payment_method=_S, day_of_week=_S, month_name=_S, year=_I,
    month_number=_I, is_weekend=T.BooleanType(), revenue_category=_S,
    processed_timestamp=T.TimestampType(), total_cents=_L)

# Documented columns of the source table (data contract, Q5).
SOURCE_DOCS = {c: DOCS[c] for c in RAW_COLUMNS if c != "time"}

CRITICAL_COLUMNS = ["transaction_id", "date", "shop_id", "product_name",
                    "unit_price", "quantity", "total_amount"]

# Total order that decides which copy of a duplicated transaction id is kept.
DEDUP_ORDER = ["date", "shop_id", "product_name", "category", "quantity",
               "total_amount", "unit_price", "customer_id",
               "shop_name", "city", "payment_method", "time"]
