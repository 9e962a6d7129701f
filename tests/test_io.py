"""Sources, sinks, variant staging, quality checks, examples and streaming."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillroll import queries
from tillroll.operators import clean as cl
from tillroll.operators import quality
from tillroll.plans import examples
from tillroll.session import scratch_path
from tillroll.sources import files
from tillroll.sources.schema import PROCESSED_SCHEMA, SOURCE_DOCS
from tillroll.streaming import ingest


def test_csv_read_keeps_malformed_line(spark, tmp_path):
    p = tmp_path / "shop1.csv"
    p.write_text(
        "transaction_id,date,time,shop_id,shop_name,city,product_name,category,quantity,"
        "unit_price,total_amount,customer_id,payment_method\n"
        "TXN000001,2025-03-01,09:15,SHOP001,Shop,Harbourtown,Milk,Grocery,2,3.50,7.00,CUST0001,card\n"
        "TXN000002,2025-03-01,\"unterminated\n")
    df = files.read_raw_csv(spark, str(tmp_path)).cache()
    assert df.count() == 2
    good = df.filter(F.col("_corrupt_record").isNull()).first()
    assert good.time == "09:15" and good.total_amount == "7.00"
    typed = cl.parse_raw(df.drop("_corrupt_record"))
    assert typed.filter(F.col("total_amount") == 7.0).count() == 1


def test_partitioned_parquet_roundtrip_and_idempotent(spark):
    rows = [("T1", dt.date(2025, 3, 1), 2025, 3, 700), ("T2", dt.date(2025, 4, 2), 2025, 4, 900)]
    df = spark.createDataFrame(rows, "transaction_id string, date date, year int, "
                                     "month_number int, total_cents long")
    path = scratch_path(spark, "test_processed")
    files.write_processed(df, path)
    files.write_processed(df, path)            # same input again: no duplicates
    back = files.read_processed(spark, path, df.schema)
    assert sorted(r.transaction_id for r in back.collect()) == ["T1", "T2"]
    assert dict(back.dtypes)["month_number"] == "int"
    april = df.filter("month_number = 4")
    files.write_processed(april.withColumn("total_cents", F.lit(1).cast("long")), path, increment=True)
    assert {r.transaction_id: r.total_cents for r in
            files.read_processed(spark, path, df.schema).collect()} == {"T1": 700, "T2": 1}
    files.write_processed(april, path)         # a full load: March is gone
    assert [r.transaction_id for r in files.read_processed(spark, path, df.schema).collect()] == ["T2"]


def test_variant_stage_roundtrip_and_bad_cast(spark):
    df = spark.createDataFrame([("T1", dt.date(2025, 3, 1), 2, "x")],
                               "transaction_id string, date date, quantity int, s string")
    stage = files.to_variant_stage(df)
    back = files.from_variant_stage(stage, df.schema).first()
    assert (back.transaction_id, back.date, back.quantity, back.s) == \
        ("T1", dt.date(2025, 3, 1), 2, "x")
    text = spark.createDataFrame([('{"quantity": "abc"}',), ("{bad json",)], "value string")
    st = files.parse_json_stage(text)
    assert files.loaded(st).count() == 1 and files.rejected(st).first().line == "{bad json"
    q = files.loaded(st).select(F.try_variant_get("raw_data", "$.quantity", "int").alias("q")).first()
    assert q.q is None


def test_quality_checks(spark):
    first = examples.first_model(spark)
    assert quality.not_null_violations(first, "id").count() == 1     # fails by design
    assert quality.unique_violations(first, "id").count() == 0
    second = examples.second_model(first)
    assert [r.id for r in second.collect()] == [1]
    assert quality.not_null_violations(second, "id").count() == 0
    dup = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert [(r.id, r.n_rows) for r in quality.unique_violations(dup, "id").collect()] == [(1, 2)]


def test_amount_consistency(spark):
    df = spark.createDataFrame([("T1", 2.50, 3, 750), ("T2", 2.50, 3, 751)],
                               "transaction_id string, unit_price double, quantity int, "
                               "total_cents long")
    assert [r.transaction_id for r in quality.amount_violations(df).collect()] == ["T2"]


def test_documentation_gaps(spark):
    have = [(f.name, f.metadata["comment"]) for f in PROCESSED_SCHEMA.fields]
    schema = "column_name string, comment string"
    ok = quality.documentation_gaps(spark.createDataFrame(have, schema), SOURCE_DOCS)
    assert ok.count() == len(SOURCE_DOCS) and ok.filter("problem IS NOT NULL").count() == 0
    bad = [(n, "" if n == "city" else "changed" if n == "date" else c) for n, c in have if n != "shop_id"]
    gaps = quality.documentation_gaps(spark.createDataFrame(bad, schema), SOURCE_DOCS)
    assert {r.column_name: r.problem for r in gaps.filter("problem IS NOT NULL").collect()} == {
        "city": "no comment", "date": "another comment", "shop_id": "missing column"}


def test_csv_header_may_be_messy_reordered_and_wider(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Date,Transaction ID, time ,shop_id,SHOP_NAME,city,Product Name,category,quantity, Unit Price ,"
        "total_amount,customer_id,payment_method,note\n"
        "2025-03-01,T1,09:15,S1,Shop,Town,Milk,Food,2,3.5,7,C1,card,hello\n"
        "2025-03-01,T2,09:15,S1,Shop,Town,Milk,Food,2,3.5,7,C1,card,hello,too,many\n")
    df = files.read_raw_csv(spark, str(tmp_path)).cache()
    good = df.filter("_corrupt_record IS NULL").collect()
    assert df.count() == 2 and len(good) == 1
    assert (good[0].transaction_id, good[0].time, good[0].unit_price) == ("T1", "09:15", "3.5")
    (tmp_path / "a.csv").write_text("Date,Transaction ID\n2025-03-01,T1\n")
    with pytest.raises(ValueError, match="shop_id"):
        files.read_raw_csv(spark, str(tmp_path))


def test_json_records_lowercase(spark):
    df = spark.createDataFrame([("A", dt.date(2025, 3, 1))], "SHOP_ID string, D date")
    assert files.json_records(df).first().json == '{"shop_id":"A","d":"2025-03-01"}'


def test_stream_drops_rows_beyond_watermark(spark):
    """A row older than the watermark is not counted; the run reports it."""
    root = scratch_path(spark, "test_stream")
    landing = f"{root}/landing"
    cfg = ingest.StreamConfig(watermark="1 hour")
    job = ingest.IncrementalIngest(spark, landing, root, cfg)
    schema = ingest.EVENT_SCHEMA
    first = [(1, dt.datetime(2024, 1, 5, 12, 0), 1, "shopA", 5.0, None)]
    late = [(2, dt.datetime(2024, 1, 1, 12, 0), 1, "shopA", 7.0, None),
            (1, dt.datetime(2024, 1, 5, 12, 0), 1, "shopA", 5.0, None)]   # replay
    spark.createDataFrame(first, schema).write.parquet(f"{landing}/a")
    job.landing = f"{landing}/*"
    job.run_silver()
    spark.createDataFrame(late, schema).write.parquet(f"{landing}/b")
    job.run_silver()
    job.write_late()
    silver = spark.read.schema(job.silver_schema()).parquet(job.silver)
    assert [r.transaction_id for r in silver.collect()] == ["1"]
    lost = spark.read.schema(job.silver_schema()).parquet(job.late)
    assert [r.transaction_id for r in lost.collect()] == ["2"]     # the replay is no loss


def test_late_rows_are_exact_over_many_micro_batches(spark):
    """Far more micro-batches than Spark keeps progress reports for."""
    root = scratch_path(spark, "test_stream_many")
    landing = f"{root}/landing"
    job = ingest.IncrementalIngest(spark, landing, root, ingest.StreamConfig(
        watermark="1 hour", max_bytes_per_trigger="1", state_partitions=1, state_store=None))
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(days=i if i % 10 else 0), 1, "A", 1.0, None) for i in range(1, 106)]
    for i, r in enumerate(rows):
        (spark.createDataFrame([r], ingest.EVENT_SCHEMA).coalesce(1)
         .write.parquet(f"{landing}/f{i:04d}"))
    job.landing = f"{landing}/f*"
    job.run_silver()
    job.write_late()
    silver = spark.read.schema(job.silver_schema()).parquet(job.silver)
    late = spark.read.schema(job.silver_schema()).parquet(job.late)
    assert silver.count() + late.count() == 105
    assert sorted(int(r.transaction_id) for r in late.collect()) == list(range(10, 106, 10))


def test_cleaning_job_audit_matches_row_audit(spark):
    from tillroll.operators import clean as clean_ops
    from tillroll.params import FIXTURE
    from tillroll.plans import staging
    from tillroll.sources import fixture
    from conftest import SF_SMALL
    dirty = fixture.dirty_transactions(spark, SF_SMALL)
    audit = staging.cleaning_job(dirty, FIXTURE, scratch_path(spark, "test_clean_job"))
    ref = clean_ops.row_audit(dirty, FIXTURE).first().asDict()
    assert audit == ref


def test_warehouses_do_not_share_tables(spark):
    """Folder A, B, A again: each sees its own data; a user's own table stays."""
    from conftest import SF_CHECK, SF_SMALL
    from tillroll import queries as Q
    spark.sql(f"CREATE DATABASE marts LOCATION '{scratch_path(spark, 'user_db')}'")
    spark.range(1).toDF("x").write.saveAsTable("marts.shop_performance")
    a = sorted(map(tuple, Q.warehouse_revenue_by_shop(spark, SF_SMALL).collect()))
    b = sorted(map(tuple, Q.warehouse_revenue_by_shop(spark, SF_CHECK).collect()))
    assert a != b and sorted(map(tuple, Q.warehouse_revenue_by_shop(spark, SF_SMALL).collect())) == a
    assert sorted(map(tuple, Q.revenue_by_shop(spark, SF_SMALL).collect())) == a
    wh = Q._published(spark, SF_SMALL)
    raw = wh.source("raw", "transactions")
    months = raw.select("year", "month_number").distinct().count()
    assert len(raw.inputFiles()) <= 2 * months
    assert spark.table("marts.shop_performance").columns == ["x"]
    docs = {r.column_name: r.comment for r in wh.columns("raw", "transactions").collect()}
    assert docs == {f.name: f.metadata["comment"] for f in PROCESSED_SCHEMA.fields}
    spark.sql("DROP TABLE marts.shop_performance")
    spark.sql("DROP DATABASE marts")


def test_models_see_new_files_and_drop_old_tables(spark, tmp_path):
    import shutil
    from conftest import SF_SMALL
    from tillroll.plans.models import TABLES, models
    for t in TABLES:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    first = models(spark, str(tmp_path))
    n = first.processed().count()
    old = first.processed().inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert models(spark, str(tmp_path)) is first
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter("l_orderkey % 2 = 0")
    (tmp_path / "lineitem.parquet").unlink()
    half.write.parquet(str(tmp_path / "lineitem.parquet"))
    again = models(spark, str(tmp_path))
    assert again is not first and again.processed().count() < n
    assert not os.path.exists(old)


def test_gold_compaction_keeps_latest_versions(spark):
    root = scratch_path(spark, "test_compact")
    landing = f"{root}/landing"
    job = ingest.IncrementalIngest(spark, landing, root, ingest.StreamConfig(watermark="10 days"))
    schema = ingest.EVENT_SCHEMA
    day = dt.datetime(2024, 1, 2, 10, 0)
    job.landing = f"{landing}/*"
    spark.createDataFrame([(1, day, 1, "A", 5.0, None)], schema).write.parquet(f"{landing}/a")
    job.run_silver(); job.run_gold()
    assert job.compact() is not None
    spark.createDataFrame([(2, day, 2, "A", 7.0, None), (3, day, 3, "B", 1.0, None)],
                          schema).write.parquet(f"{landing}/b")
    job.run_silver(); job.run_gold()
    rows = {r.shop_id: (r.revenue_cents, r.transactions) for r in job.latest_windows().collect()}
    assert rows == {"A": (1200, 2), "B": (100, 1)}
    job.compact()
    again = {r.shop_id: (r.revenue_cents, r.transactions) for r in job.latest_windows().collect()}
    assert again == rows


def test_shop_folders_keep_blanks(spark, tmp_path):
    cols = [c for c in files.RAW_COLUMNS]
    rows = [(" T1", *["x"] * 12), ("T1 ", *["x"] * 12), ("T1", *[" y "] * 12)]
    df = spark.createDataFrame([(*r[:3], "S1", *r[4:]) for r in rows], cols)
    files.write_raw_csv_by_shop(df, str(tmp_path / "shops"))
    back = files.read_raw_csv_by_shop(spark, str(tmp_path / "shops")).drop("_corrupt_record").select(cols)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_a_header_with_one_name_twice_is_refused(spark, tmp_path):
    names = [*files.RAW_COLUMNS, "Shop ID"]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join("x" * len(names)) + "\n")
    with pytest.raises(ValueError, match="shop_id more than once"):
        files.read_raw_csv(spark, str(tmp_path))


def test_ordered_dedup_does_not_depend_on_arrival(spark):
    """Copies that land before their events and after them give the same rows, each the
    least of its copies, whatever the number of batches."""
    cfg = ingest.StreamConfig(watermark="16 days", state_partitions=2)
    found = []
    for slices, first in ((3, False), (3, True), (5, False)):
        job = ingest.replay_in_slices(spark, SF_SMALL, cfg, slices, ordered=True, copies_first=first)
        silver = spark.read.schema(job.silver_schema()).parquet(job.silver)
        found.append(sorted(map(str, silver.collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 100
    ids = [r.split("'")[1] for r in found[0]]
    assert len(ids) == len(set(ids))


def _scanned(df):
    """Rows that the scan of a collected query handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    while True:
        below = plan.children()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            plan = plan.executedPlan()
        elif below.size():
            plan = below.apply(0)
        else:
            return plan.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.format_string("T%08d", "id").alias("transaction_id"),
        F.format_string("C%06d", F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("customer_id"))
    path = str(tmp_path / "lookup")
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 << 10))
    try:
        files.write_lookup(rows, path, "transaction_id", ["customer_id"], distinct=10_000)
    finally:
        hadoop.unset("parquet.block.size")
    for col, value in (("transaction_id", "T00123456"), ("customer_id", "C000042"), ("customer_id", "none")):
        found = files.lookup(spark, path, rows.schema, col, value)
        got = found.collect()
        assert sorted(got) == sorted(rows.filter(F.col(col) == value).collect())
        assert _scanned(found) < 150_000


def test_state_partitions_follow_the_input():
    mb = 1 << 20
    assert [ingest.state_partitions(n) for n in (0, 2 * mb, 32 * mb, 33 * mb, 720 * mb)] == [4, 4, 4, 5, 90]
    sized = queries._sized(queries._SLICE_STREAM, (1, 720 * mb, 0))
    assert sized.state_partitions == 90 and sized.watermark == queries._SLICE_STREAM.watermark
