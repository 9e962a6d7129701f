"""Cleaning: name normalisation, typed parsing, triage and deterministic dedup.

The reference drops rows with a NULL critical column, keeps one row per
transaction id (an arbitrary one), and only then drops impossible values and
dates outside the window. Here the kept copy is the first in a fixed total
order (``DEDUP_ORDER``, NULLs last), chosen by an aggregation rather than a
window: ``min(struct(order…, rest…))`` per id is combined map-side before the
shuffle, so an id repeated millions of times never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Params
from ..sources.schema import CRITICAL_COLUMNS, DEDUP_ORDER

REASONS = ["null_critical", "duplicate", "impossible_value", "date_out_of_range", "ok"]


def plain_name(header: str) -> str:
    """A column name as the library writes it: no blanks around, one underscore for each
    blank inside, lower case."""
    return "_".join(header.strip().lower().split(" "))


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(plain_name(c)) for c in df.columns])


def parse_raw(df: DataFrame) -> DataFrame:
    """Raw text columns → TYPED_SCHEMA. Unparsable values become NULL (never an
    error), so that the NULL rule removes them. Keys and names are taken as they are
    (" A2" and "A2" are two ids) and amounts are not rounded."""
    df = normalise_columns(df)
    return df.select(
        "transaction_id",
        F.try_to_date(F.trim("date"), "yyyy-MM-dd").alias("date"),
        F.col("time").cast("string").alias("time"),
        "shop_id", "shop_name", "city", "product_name", "category",
        F.trim("quantity").try_cast("int").alias("quantity"),
        F.trim("unit_price").try_cast("double").alias("unit_price"),
        F.trim("total_amount").try_cast("double").alias("total_amount"),
        "customer_id", "payment_method",
    )


def critical_null(cols=CRITICAL_COLUMNS) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def _order_struct(df: DataFrame, key: str, order: list[str], within: Sequence[str] = ()) -> Column:
    """Struct whose natural ordering is `order` ascending with NULLs last,
    followed by every remaining column (so the minimum is one whole row)."""
    fields = []
    for i, c in enumerate(order):
        fields.append(F.col(c).isNull().alias(f"_o{i}_null"))
        fields.append(F.col(c).alias(f"_o{i}"))
    rest = [c for c in df.columns if c != key and c not in order and c not in within]
    fields += [F.col(c).alias(c) for c in rest]
    return F.struct(*fields)


def _unpack(key: str, order: list[str], columns: list[str], s: str) -> list[Column]:
    pos = {c: f"{s}._o{i}" for i, c in enumerate(order)}
    return [F.col(key) if c == key else F.col(pos.get(c, f"{s}.{c}")).alias(c)
            for c in columns]


def valid_values() -> Column:
    """C3, on the amount as delivered: 0.004 is a value, not an impossible one."""
    return (F.col("unit_price") > 0) & (F.col("quantity") > 0) & (F.col("total_amount") > 0)


def in_window(p: Params) -> Column:
    upper = F.lit(p.as_of) if p.as_of else F.current_date()
    return (F.col("date") >= F.lit(p.min_date)) & (F.col("date") <= upper)


def _usable(typed: DataFrame) -> Column:
    return ~critical_null([c for c in CRITICAL_COLUMNS if c in typed.columns])


def _order(typed: DataFrame, key: str) -> list[str]:
    return [c for c in DEDUP_ORDER if c in typed.columns and c != key]


def deduplicated(typed: DataFrame, key: str = "transaction_id", within: Sequence[str] = ()) -> DataFrame:
    """Rows without NULL critical columns, one per id (C1 + C2). `within` names further
    columns that the id determines: grouped by too they change no group, and rows that
    already lie dealt by them are not shuffled again. They are left out of the result."""
    order = _order(typed, key)
    kept = (typed.filter(_usable(typed)).groupBy(*within, key)
            .agg(F.min(_order_struct(typed, key, order, within)).alias("_k")))
    return kept.select(*_unpack(key, order, [c for c in typed.columns if c not in within], "_k"))


def clean(typed: DataFrame, p: Params, within: Sequence[str] = ()) -> DataFrame:
    """C1 NULL rule → C2 dedup → C3 positive values → C4 date window."""
    return deduplicated(typed, within=within).filter(valid_values() & in_window(p))


def _kept_reason(p: Params) -> Column:
    return (F.when(~valid_values(), "impossible_value")
            .when(~in_window(p), "date_out_of_range")
            .otherwise("ok"))


def reason_counts(typed: DataFrame, p: Params, key: str = "transaction_id") -> DataFrame:
    """Q3: number of input rows per reject reason (precedence: null_critical →
    duplicate → impossible_value → date_out_of_range → ok), one shuffle."""
    order = _order(typed, key)
    ok = _usable(typed)
    # rows whose id is NULL fall in the NULL-key group and count as null_critical
    t = typed.groupBy(key).agg(
        F.count_if(~ok).alias("_n_null"), F.count_if(ok).alias("_n_valid"),
        F.min(F.when(ok, _order_struct(typed, key, order))).alias("_k"))
    kept = t.select("_n_null", "_n_valid", *_unpack(key, order, typed.columns, "_k"))
    reason = F.when(F.col("_n_valid") > 0, _kept_reason(p))
    one = kept.agg(
        F.sum("_n_null").alias("null_critical"),
        F.sum(F.greatest(F.col("_n_valid") - 1, F.lit(0))).alias("duplicate"),
        F.count_if(reason == "impossible_value").alias("impossible_value"),
        F.count_if(reason == "date_out_of_range").alias("date_out_of_range"),
        F.count_if(reason == "ok").alias("ok"),
    )
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("reject_reason"),
                 F.coalesce(F.col(r), F.lit(0)).cast("bigint").alias("n_rows"))
        for r in REASONS])).alias("r")).select("r.*")


def row_audit(typed: DataFrame, p: Params) -> DataFrame:
    """Raw, after NULL rule, after dedup, clean, removed — one row, one pass."""
    rc = reason_counts(typed, p)
    n = {r: F.sum(F.when(F.col("reject_reason") == r, F.col("n_rows")).otherwise(0))
         for r in REASONS}
    raw = n["null_critical"] + n["duplicate"] + n["impossible_value"] + \
        n["date_out_of_range"] + n["ok"]
    return rc.agg(
        raw.cast("bigint").alias("raw_rows"),
        (raw - n["null_critical"]).cast("bigint").alias("non_null_rows"),
        (raw - n["null_critical"] - n["duplicate"]).cast("bigint").alias("deduplicated_rows"),
        n["ok"].cast("bigint").alias("clean_rows"),
        (raw - n["ok"]).cast("bigint").alias("removed_rows"),
    )
