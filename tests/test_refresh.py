"""Incremental refresh against full builds, what it reads, and customer sketches."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillroll.plans import marts, refresh
from tillroll.plans.models import models
from tillroll.plans.staging import stg_transactions
from tillroll.session import scratch_path
from tillroll.sources import files

SKIP = ("updated_at",)


def rows(df):
    cols = sorted(c for c in df.columns if c not in SKIP)
    return sorted(str(r) for r in df.select(*cols).collect())


def same_as_full(job, src):
    stg = stg_transactions(src)
    assert rows(job.daily_revenue()) == rows(marts.daily_revenue(stg))
    assert rows(job.top_products()) == rows(marts.top_products(stg))
    assert rows(job.shop_performance()) == rows(marts.shop_performance(stg))


@pytest.fixture
def built(spark):
    src = models(spark, SF_SMALL).processed().filter("year = 1997 AND month_number <= 4")
    root = scratch_path(spark, "test_refresh")
    files.write_processed(src, f"{root}/processed")
    return refresh.IncrementalMarts(spark, f"{root}/processed", f"{root}/marts").refresh(), src, root


def test_full_build_and_repeated_refresh(built):
    job, src, _ = built
    same_as_full(job, src)
    job.refresh([(1997, 2)]).refresh([(1997, 2)]).refresh([])
    same_as_full(job, src)


def test_a_refresh_reads_only_the_touched_months(built, spark):
    job, src, root = built
    march = (src.filter("month_number = 3").withColumn("total_cents", F.col("total_cents") * 2)
             .withColumn("customer_id", F.lit("CUST1")))
    files.write_processed(march, job.processed, increment=True)
    assert refresh.touched_months(march) == [(1997, 3)]
    plan = job.staging([(1997, 3)])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "month_number" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # the other months' files are not there to be read
    for month in (1, 2, 4):
        shutil.move(f"{job.processed.removeprefix('file:')}/year=1997/month_number={month}",
                    f"{root.removeprefix('file:')}/aside{month}")
    job.refresh([(1997, 3)])
    same_as_full(job, src.filter("month_number <> 3").unionByName(march))


def test_a_month_without_rows_is_dropped(built):
    job, src, _ = built
    shutil.move(f"{job.processed.removeprefix('file:')}/year=1997/month_number=2",
                job.root.removeprefix("file:") + "-february")
    job.refresh([(1997, 2)])
    same_as_full(job, src.filter("month_number <> 2"))


def test_a_new_month_with_null_customers_and_a_new_shop(built, spark):
    job, src, _ = built
    may = (src.filter("month_number = 4").withColumn("date", F.add_months("date", 1))
           .withColumn("month_number", F.lit(5))
           .withColumn("customer_id", F.when(F.col("total_cents") % 2 == 0, F.col("customer_id")))
           .withColumn("shop_id", F.when(F.col("total_cents") % 3 == 0, "SHOPNEW").otherwise(F.col("shop_id"))))
    files.write_processed(may, job.processed, increment=True)
    job.refresh(refresh.touched_months(may))
    back = files.read_processed(spark, job.processed, src.schema)
    same_as_full(job, back)


def test_sketches_merge_over_spans_and_shops(spark):
    """Overlapping customers in days and shops: unions, not sums."""
    day = F.date_add(F.lit(dt.date(1997, 1, 1)), (F.col("id") % 20).cast("int"))
    sales = spark.range(60_000).select(
        day.alias("transaction_date"), F.concat(F.lit("S"), F.col("id") % 3).alias("shop_id"),
        F.concat(F.lit("C"), F.xxhash64("id") % 9_000).alias("customer_id"))
    days = sales.groupBy("transaction_date", "shop_id").agg(
        F.hll_sketch_agg("customer_id", F.lit(refresh.LG_K)).alias("customer_sketch"))
    for span in (1, 7, 20):
        held = F.col("transaction_date") < F.date_add(F.lit(dt.date(1997, 1, 1)), span)
        for by in ([], ["shop_id"]):
            near = {r[:-1]: r[-1] for r in refresh.customers_approx(days.filter(held), by).collect()}
            exact = sales.filter(held).groupBy(*by).agg(F.countDistinct("customer_id")).collect()
            assert len(near) == len(exact)
            for r in exact:
                assert abs(near[r[:-1]] - r[-1]) <= 4 * refresh.ERROR * r[-1] + 1


def test_an_empty_processed_table(spark):
    src = models(spark, SF_SMALL).processed()
    root = scratch_path(spark, "test_refresh_empty")
    files.write_processed(src.filter("year = 1997 AND month_number = 1"), f"{root}/processed")
    job = refresh.IncrementalMarts(spark, f"{root}/processed", f"{root}/marts").refresh()
    files.write_processed(src.filter("false"), f"{root}/processed")
    job.refresh([(1997, 1)])
    assert job.days().count() == 0


def test_partials_are_dealt_once_by_month(built):
    job, _, _ = built
    for name, df in refresh.partials(job.staging()).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange rangepartitioning(year") == 1, name
        assert plan.count("Exchange") == (2 if name == "shops" else 1), name
