"""Cleaning rules: parsing, NULL rule, deterministic dedup, value and date filters."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import clean as cl
from tillroll.params import Params
from tillroll.sources.schema import RAW_COLUMNS

P = Params(min_date=dt.date(2020, 1, 1), as_of=dt.date(2026, 3, 1))


def _raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in RAW_COLUMNS))


def row(tid, date="2025-03-01", time="09:15", qty="2", price="10.00", total="20.00",
        product="Milk", customer="CUST0001"):
    return (tid, date, time, "SHOP001", "Shop", "Harbourtown", product, "Grocery", qty, price,
            total, customer, "card")


def test_header_names_are_normalised(spark):
    df = spark.createDataFrame([(1, 2)], "` Unit Price ` int, SHOP_NAME int")
    assert cl.normalise_columns(df).columns == ["unit_price", "shop_name"]


def test_bad_values_become_null_and_time_stays_text(spark):
    typed = cl.parse_raw(_raw(spark, [row("T1", date="2026-99-02", qty="abc", total="x1")]))
    r = typed.first()
    assert r.date is None and r.quantity is None and r.total_amount is None
    assert r.time == "09:15"


def test_reject_reasons_precedence(spark):
    rows = [
        row("T1"),                                   # ok
        row("T2", product=None),                     # null_critical
        row("T3", total="0"),                        # impossible_value
        row("T4", total="-5.00"),                    # impossible_value
        row("T5", date="2019-12-31"),                # date_out_of_range
        row("T6", date="2026-03-02"),                # future: date_out_of_range
        row("T7", customer="CUST0002"),              # duplicate pair: the smaller
        row("T7", customer="CUST0001"),              #   customer id is kept
        row("T8", date="bad"),                       # null_critical (unparsable date)
    ]
    typed = cl.parse_raw(_raw(spark, rows))
    got = {r.reject_reason: r.n_rows for r in cl.reason_counts(typed, P).collect()}
    assert got == {"null_critical": 2, "duplicate": 1, "impossible_value": 2,
                   "date_out_of_range": 2, "ok": 2}
    kept = {r.transaction_id: r.customer_id for r in cl.clean(typed, P).collect()}
    assert kept == {"T1": "CUST0001", "T7": "CUST0001"}
    audit = cl.row_audit(typed, P).first()
    assert (audit.raw_rows, audit.non_null_rows, audit.deduplicated_rows,
            audit.clean_rows, audit.removed_rows) == (9, 7, 6, 2, 7)


def test_dedup_runs_before_value_filters(spark):
    # the first copy in the total order is invalid; the id must not survive
    rows = [row("T1", date="2025-03-01", total="0"), row("T1", date="2025-03-02")]
    typed = cl.parse_raw(_raw(spark, rows))
    assert cl.clean(typed, P).count() == 0


def test_dedup_nulls_last_in_order(spark):
    rows = [row("T1", customer=None), row("T1", customer="CUST0009")]
    typed = cl.parse_raw(_raw(spark, rows))
    assert cl.deduplicated(typed).first().customer_id == "CUST0009"


def test_keep_first_on_hot_key_is_whole(spark):
    # one id holds most rows; result is one row, every other id untouched
    rows = [row("HOT", customer=f"C{i:05d}") for i in range(3000)] + \
           [row(f"T{i}") for i in range(100)]
    typed = cl.parse_raw(_raw(spark, rows))
    d = cl.deduplicated(typed)
    assert d.count() == 101
    assert d.filter("transaction_id = 'HOT'").first().customer_id == "C00000"


def test_amounts_and_ids_are_judged_as_delivered(spark):
    """0.004 is positive, 19.996 is below 20, and " A2" is another id than "A2"."""
    from tillroll.operators.enrich import enrich
    from tillroll.plans.staging import stg_transactions
    rows = [row("A1", total="0.004"), row("A2", total="19.996"), row(" A2", total="20")]
    got = {r.transaction_id: r for r in enrich(cl.clean(cl.parse_raw(_raw(spark, rows)), P), P).collect()}
    assert set(got) == {"A1", "A2", " A2"}
    assert [got[k].revenue_category for k in ("A1", "A2", " A2")] == ["Low", "Low", "Medium"]
    assert got["A2"].total_amount == 19.996 and got["A2"].total_cents == 2000
    stg = stg_transactions(enrich(cl.clean(cl.parse_raw(_raw(spark, rows)), P), P))
    assert sorted(r.total_amount for r in stg.collect()) == [0.0, 20.0, 20.0]


def test_dedup_within_columns_the_id_determines(spark):
    rows = [row(f"T{i // 3}", customer=f"CUST{i % 5:04d}") for i in range(60)] + [row("T1", customer=None)]
    typed = cl.parse_raw(_raw(spark, rows))
    dealt = typed.withColumn("_g", F.substring("transaction_id", 2, 1)).repartition("_g")
    got = cl.deduplicated(dealt, within=["_g"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == typed.columns and plan.count("Exchange hash") == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, cl.deduplicated(typed).collect()))
