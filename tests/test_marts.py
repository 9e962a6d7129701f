"""Model invariants on the sf0.001 fixture, and ranking against brute force."""

import os
import random
import subprocess
import sys
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.functions.money import to_cents
from tillroll.operators.ranking import ranked, top_ranked
from tillroll.plans import marts, metrics, serving, staging
from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def layers(spark):
    stg = staging.fixture_stg(spark, SF_SMALL).cache()
    return {"stg": stg, "daily": marts.daily_revenue(stg).cache(),
            "top": marts.top_products(stg).cache(),
            "shop": marts.shop_performance(stg).cache()}


def test_shop_invariants(layers):
    s = layers["shop"]
    bad = s.filter(
        (to_cents("weekend_revenue") + to_cents("weekday_revenue") != to_cents("total_revenue"))
        | (F.col("cash_transactions") + F.col("card_transactions") != F.col("total_transactions"))
        | (F.col("high_value_transactions") + F.col("medium_value_transactions")
           + F.col("low_value_transactions") != F.col("total_transactions"))
        | (F.col("weekend_transactions") + F.col("weekday_transactions")
           != F.col("total_transactions")))
    assert bad.count() == 0
    r = s.agg(F.min("revenue_rank").alias("lo"), F.sum("pct_of_total_revenue").alias("p")).first()
    assert r.lo == 1
    assert abs(r.p - 100.0) <= 0.01 * s.count()


def test_daily_sums_to_shop_totals(layers):
    d = layers["daily"].groupBy("shop_id").agg(F.sum("revenue_cents").alias("d"))
    s = layers["shop"].select("shop_id", "revenue_cents")
    assert d.join(s, "shop_id").filter(F.col("d") != F.col("revenue_cents")).count() == 0


def test_product_shares_and_ranks(layers):
    t = layers["top"]
    g = t.groupBy("shop_id").agg(F.min("revenue_rank_in_shop").alias("r"),
                                 F.sum("pct_of_shop_revenue").alias("p"),
                                 F.count(F.lit(1)).alias("n"))
    assert g.filter(F.col("r") != 1).count() == 0
    assert g.filter(F.abs(F.col("p") - 100) > F.col("n") * 0.005 + 1e-9).count() == 0


def test_daily_calendar_columns_follow_date(layers):
    d = layers["daily"]
    assert d.filter(F.col("year") != F.year("transaction_date")).count() == 0
    assert d.filter((F.col("day_type") == "Weekend") != F.col("is_weekend")).count() == 0


def test_reindex_fills_missing_weekday(spark, layers):
    only_sat = layers["daily"].filter(F.col("day_of_week") == "Saturday")
    out = serving.weekday_reindexed(only_sat).collect()
    assert [r.day_of_week for r in out] == serving.WEEKDAY_DISPLAY_ORDER
    assert all(r.avg_revenue == 0.0 for r in out[1:]) and out[0].avg_revenue > 0


def test_spine_fills_days_without_sales(layers):
    d = layers["daily"]
    spine = metrics.calendar_spine_daily(d)
    n_shops = d.select("shop_id").distinct().count()
    span = d.select(F.datediff(F.max("transaction_date"), F.min("transaction_date"))).first()[0]
    assert spine.count() == n_shops * (span + 1)
    assert spine.agg(F.sum("revenue_cents")).first()[0] == \
        d.agg(F.sum("revenue_cents")).first()[0]


def test_summary_non_additive_vs_true(layers):
    as_defined = serving.portfolio_summary(layers["shop"]).first()
    true = serving.portfolio_summary_true(layers["stg"], layers["shop"]).first()
    assert as_defined.total_revenue == true.total_revenue
    assert as_defined.total_transactions == true.total_transactions
    assert as_defined.total_customers >= true.total_customers


def _brute_rank(values, desc=True):
    return [1 + sum(1 for w in values if (w > v if desc else w < v)) for v in values]


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_global_rank_matches_brute_force(spark, ranges):
    rnd = random.Random(ranges)
    vals = [rnd.choice([5, 7, 7, 9, 11, 11, 11, 20]) * rnd.randint(1, 3) for _ in range(400)]
    vals += [None, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v long")
    got = {r.id: r.r for r in ranked(df, "v", "r", ranges=ranges).collect()}
    nonnull = [v for v in vals if v is not None]
    expect = dict(zip(range(len(nonnull)), _brute_rank(nonnull)))
    for i, v in enumerate(vals):
        if v is not None:
            assert got[i] == expect[i]
        else:
            assert got[i] == len(nonnull) + 1       # NULLS LAST, tied
    assert ranked(df.filter("false"), "v", "r").collect() == []


def test_rank_keeps_large_values_beside_nulls(spark):
    """Values over 2**53 that differ by one, in a column with a NULL."""
    big = 9007199254740993
    df = spark.createDataFrame([(1, big), (2, big - 1), (3, None), (4, big + 1)], "id int, v long")
    got = {r.id: (r.v, r.r) for r in ranked(df, "v", "r").collect()}
    assert got == {4: (big + 1, 1), 1: (big, 2), 2: (big - 1, 3), 3: (None, 4)}


def test_rank_of_mostly_tied_rows_is_spread(spark):
    """90 % of the rows share one value: no window task sees more than counted values."""
    df = spark.range(0, 20000, numPartitions=8).select(
        F.col("id"), F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("v"))
    out = ranked(df, "v", "r", ranges=4)
    w = df.withColumn("r", F.rank().over(Window.orderBy(F.desc("v"))))
    assert out.exceptAll(w.select("id", "v", F.col("r").cast("int").alias("r"))).count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "partition by" not in plan.lower() or "_n" in plan   # windows run over counts


def test_empty_input_conditional_counts(spark):
    empty = spark.createDataFrame([], "pm string")
    r = empty.agg(F.count_if(F.col("pm") == "cash").alias("e17"),
                  F.sum(F.when(F.col("pm") == "cash", 1).otherwise(0)).alias("e18")).first()
    assert r.e17 == 0 and r.e18 is None


def _brute_group_rank(rows, desc=True):
    out = {}
    for i, (g, v) in rows.items():
        same = [w for (h, w) in rows.values() if h == g and w is not None]
        if v is None:
            out[i] = len(same) + 1
        else:
            out[i] = 1 + sum(1 for w in same if (w > v if desc else w < v))
    return out


@pytest.mark.parametrize("ranges,asc", [(1, False), (4, False), (9, True)])
def test_rank_within_hot_group_matches_brute_force(spark, ranges, asc):
    rnd = random.Random(ranges)
    rows = {}
    for i in range(600):
        g = "HOT" if i % 3 else rnd.choice(["a", "b", "c", None])   # one group holds 2/3
        rows[i] = (g, rnd.choice([None, 1, 2, 2, 3, 5, 8, 8, 8, 13]))
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in rows.items()],
                               "id int, g string, v long")
    got = {r.id: r.r for r in ranked(df, "v", "r", ["g"], ascending=asc, ranges=ranges).collect()}
    assert got == _brute_group_rank(rows, desc=not asc)


def test_ranks_run_from_another_folder(tmp_path):
    """Nothing in the plan needs the library on the executors."""
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from tillroll.session import build_session\n"
            "from tillroll.operators.ranking import ranked\n"
            "s = build_session('local[2]', 2)\n"
            "print(sorted(r.r for r in ranked(s.range(5), 'id', 'r').collect()))\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         timeout=300)
    assert out.stdout.strip().endswith("[1, 2, 3, 4, 5]"), out.stderr[-2000:]


def test_shop_lookup_argument_is_text(layers):
    shop = layers["shop"]
    sid = shop.select("shop_id").first().shop_id
    assert serving.shop_by_id(shop, "x' OR '1'='1").count() == 0
    assert serving.shop_by_id(shop, sid.lower()).count() == 1


def test_insight_context_grain_is_fixed_with_ties(layers):
    import json
    top, shop, daily = layers["top"], layers["shop"], layers["daily"]
    hot = top.groupBy("shop_id").count().orderBy(F.desc("count"), "shop_id").first().shop_id
    # every product of the hot shop tied at rank 1: each is a row of its own
    tied = top.withColumn("revenue_rank_in_shop", F.when(
        F.col("shop_id") == hot, F.lit(1)).otherwise(F.col("revenue_rank_in_shop")))
    out = metrics.insight_context(shop, tied, daily, k=3)
    rows = out.filter((F.col("shop_id") == hot) & (F.col("section") == "product")).collect()
    assert {r.position for r in rows} == {1}
    names = [json.loads(r.json)["product_name"] for r in rows]
    expect = [r.product_name for r in tied.filter(F.col("shop_id") == hot).collect()]
    assert sorted(names) == sorted(expect)
    assert out.filter("section = 'shop'").count() == shop.count()
    assert out.filter("section = 'weekday' AND shop_id IS NULL").count() == 7


def test_bottom_products_matches_ascending_rank_brute_force(spark):
    rng = random.Random(7)
    rows = [("HOT", "Hot", f"p{i}", "c", float(rng.choice([1, 2, 3, 5])))
            for i in range(300)]
    rows += [("S2", "Two", f"q{i}", "c", float(rng.randint(1, 50))) for i in range(20)]
    rows += [("S3", "Three", "r0", "c", None), ("S3", "Three", "r1", "c", None)]
    rows += [("S4", "Four", "t0", "c", None), ("S4", "Four", "t1", "c", 4.5)]
    top = spark.createDataFrame(
        rows, "shop_id string, shop_name string, product_name string, category string, "
              "total_revenue double")
    got = sorted((r.shop_id, r.product_name) for r in metrics.bottom_products(top).collect())
    expect = []
    for shop in {r[0] for r in rows}:
        vals = [r[4] for r in rows if r[0] == shop and r[4] is not None]
        lo = min(vals) if vals else None
        expect += [(r[0], r[2]) for r in rows if r[0] == shop and r[4] == lo]
    assert got == sorted(expect)


def test_shop_mart_and_top_from_a_given_product_table(layers):
    products = marts.product_aggregates(layers["stg"]).cache()
    shop = layers["shop"].drop("updated_at")
    assert sorted(shop.collect()) == sorted(
        marts.shop_performance(layers["stg"], products).drop("updated_at").collect())
    top = layers["top"].drop("updated_at")
    assert sorted(top.collect()) == sorted(
        marts.top_products(layers["stg"], products).drop("updated_at").collect())


def test_filled_weekdays_equal_the_grid(layers):
    from tillroll.functions.money import avg_amount
    s = metrics.calendar_spine_daily(layers["daily"])
    g = s.groupBy("day_of_week").agg(F.sum("revenue_cents").alias("_s"), F.count("revenue_cents").alias("_n"))
    want = g.select("day_of_week", avg_amount("_s", "_n"), "_n").collect()
    assert sorted(map(tuple, want)) == sorted(map(tuple, metrics.revenue_by_weekday_filled(layers["daily"]).collect()))


def test_ranges_below_by_binary_search(spark):
    from tillroll.operators.ranking import ranges_below
    for n in (1, 2, 3, 7, 8, 9, 100):
        bounds = [3 * i for i in range(n)]
        df = spark.range(-2, 3 * n + 3).select("id", ranges_below(bounds, F.col("id")).alias("below"))
        assert all(r["below"] == sum(b < r["id"] for b in bounds) for r in df.collect())


def test_top_ranked_equals_the_filtered_rank(spark):
    """Ties, NULL values, NULL groups, groups smaller than k, one group of most rows."""
    rng = random.Random(6)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1, 2, 2, 3, rng.randrange(40)]))
            for _ in range(600)] + [("c", 7), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    for groups in (["g"], None):
        for ascending in (False, True):
            for k in (1, 3, 500):
                got = top_ranked(df, "v", "r", k, groups, ascending)
                want = ranked(df, "v", "r", groups, ascending).filter(F.col("r") <= k)
                assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_top_ranked_keeps_k_values_a_task(spark):
    """Spark's group limit runs before and after the shuffle; no window sees the rest."""
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 101).alias("v"))
    plan = top_ranked(df, "v", "r", 4, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_bucketed_models_join_without_an_exchange(spark):
    from conftest import SF_SMALL
    from tillroll.plans.models import models
    from tillroll.plans.warehouse import Warehouse
    from tillroll.session import scratch_path
    w = Warehouse(spark, "tillroll_bucket_test", scratch_path(spark, "warehouse"), 4).publish(models(spark, SF_SMALL))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = w.shop_reconciliation()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert all(r["shop_revenue"] == r["revenue_by_day"] == r["revenue_by_product"] for r in df.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_daily_counts_by_one_exchange(spark):
    base = staging.fixture_stg(spark, SF_SMALL).limit(400).drop(
        "shop_id", "shop_name", "product_name", "customer_id", "transaction_date")
    i = F.row_number().over(Window.orderBy("transaction_id"))
    stg = base.withColumn("_i", i).select(
        *base.columns, F.concat(F.lit("S"), F.col("_i") % 3).alias("shop_id"),
        F.when(F.col("_i") % 2 == 0, "x").alias("shop_name"),
        F.when(F.col("_i") % 7 > 0, F.concat(F.lit("P"), F.col("_i") % 7)).alias("product_name"),
        F.when(F.col("_i") % 11 > 0, F.concat(F.lit("C"), F.col("_i") % 11)).alias("customer_id"),
        F.date_add(F.lit("1997-01-30"), (F.col("_i") % 4).cast("int")).alias("transaction_date"))
    stg = stg.localCheckpoint()
    keys = marts.DAY_KEYS
    want = stg.groupBy(*keys).agg(
        F.countDistinct("product_name").alias("p"), F.countDistinct("customer_id").alias("c"),
        F.sum("total_cents").alias("s"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("payment_method") == "cash").alias("cash"))
    for by in (None, ["month_number", "shop_id"]):
        got = marts.day_sums(stg.withColumn("month_number", F.month("transaction_date")), by)
        got = got.select(*keys, "unique_products_sold", "unique_customers", "_sum", "total_transactions",
                         "cash_transactions")
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str(tuple(r)) for r in want.collect())


def test_cleaning_shuffles_the_widened_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = staging.fixture_processed(spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(transaction_id" not in plan and "SortAggregate" in plan


def test_publishing_keeps_no_table_twice(spark):
    """The named tables are the only copies of models written for them, with the rows that
    models built without a warehouse have; models written before stay where they are."""
    from tillroll.operators.materialize import folder_state, reads_below
    from tillroll.plans.models import ModelSet
    from tillroll.plans.warehouse import Warehouse
    from tillroll.session import scratch_path

    def rows(df):
        return sorted(map(str, df.drop("updated_at", "processed_timestamp").collect()))

    plain, ms = ModelSet(spark, SF_SMALL), ModelSet(spark, SF_SMALL)
    w = Warehouse(spark, "tillroll_once_test", scratch_path(spark, "warehouse"), 4)
    base = w.root.rsplit("/", 1)[0]
    before = {p.name for p in os.scandir(base.removeprefix("file:"))} if os.path.isdir(base.removeprefix("file:")) else set()
    w.publish(ms)
    for name in ("processed", "daily", "top", "shop"):
        assert rows(getattr(ms, name)()) == rows(getattr(plain, name)())
        assert reads_below(getattr(ms, name)(), w.root) and not reads_below(getattr(plain, name)(), w.root)
    assert sorted(map(str, w.shop_reconciliation().collect())) == sorted(map(str, Warehouse(
        spark, "tillroll_copy_test", scratch_path(spark, "warehouse"), 4).publish(plain)
        .shop_reconciliation().collect()))
    assert not reads_below(plain.top(), w.root) and plain.missing() == set()
    assert folder_state(spark, w.root)[0] > 0
    # of the tables made for `ms` none but the small shop aggregate and totals is left
    kept = {f.rsplit("/", 2)[-2] for df in plain._t.values() for f in df.inputFiles()}
    left = {p.name for p in os.scandir(base.removeprefix("file:"))} - before - kept
    assert not [x for x in left if x.split("-")[0] in
                ("processed", "product_aggregates", "daily_revenue", "top_products", "shop_performance")]


def test_written_tables_leave_no_shuffle_files(spark):
    from tillroll.operators.materialize import written

    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {str(b) for b in iter_blocks(dirs)}

    def iter_blocks(manager):
        found = manager.getAllBlocks()
        return [found.apply(i) for i in range(found.size()) if str(found.apply(i)).startswith("shuffle_")]

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(key, None), shuffles()
    t = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "seven")
    assert t.count() == 7 and spark.conf.get(key, None) == was
    for _ in range(50):  # removed behind the write's back
        if not [b for b in shuffles() - before if b.endswith(".data")]:
            break
        time.sleep(0.1)
    left = shuffles() - before
    t.groupBy("k").count().write.mode("overwrite").format("noop").save()
    assert len(shuffles() - before) > len(left)  # other queries keep theirs


def test_shop_customers_are_counted_with_null_keys(spark):
    schema = staging.fixture_stg(spark, SF_SMALL).schema
    rows = staging.fixture_stg(spark, SF_SMALL).limit(40).collect()
    rows = [{**r.asDict(), "shop_id": [None, "A", "B"][i % 3], "shop_name": [None, "x"][i % 2], "city": None,
             "customer_id": [None, "c1", "c2", "c3"][i // 6 % 4]} for i, r in enumerate(rows)]
    stg = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)
    want: dict = {}
    for r in rows:
        want.setdefault((r["shop_id"], r["shop_name"], None), set()).add(r["customer_id"])
    got = marts.shop_aggregates(stg, marts.product_aggregates(stg))
    assert {(r.shop_id, r.shop_name, r.city): r.unique_customers for r in got.collect()} == {
        k: len(v - {None}) for k, v in want.items()}
    # the exchange of customers carries no sums beside them
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "unique_customers" in plan and not any(
        "sum(total_cents" in x and "customer_id" in x for x in plan.splitlines())
