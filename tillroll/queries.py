"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the
driver's tables. Queries about sinks, layers and streams write when called and return
what they read back; the others are lazy. Load timestamps are left out of compared
outputs."""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import formatting as fmt
from .functions.money import avg_amount, cents_to_amount, to_cents
from .operators import clean as cl
from .operators import quality
from .operators.enrich import PROCESSED_COLUMNS
from .operators.materialize import discard, folder_state, written
from .operators.ranking import same_as
from .params import FIXTURE
from .plans import marts, metrics, refresh, serving, warehouse
from .plans.models import models
from .session import scratch_path
from .sources import files, fixture, loads
from .sources.schema import CRITICAL_COLUMNS, SOURCE_DOCS
from .streaming import ingest

DROP = {"updated_at", "processed_timestamp", "revenue_cents", "total_cents"}


def _public(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in DROP])


# ---- first slice: ad-hoc warehouse queries on the processed table ---------------

def revenue_by_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, average sale and count per shop name, largest first (an
    ad-hoc query on the loaded processed table)."""
    p = models(spark, sf_dir).processed()
    g = p.groupBy("shop_name").agg(F.sum("total_cents").alias("_s"),
                                   F.count("total_cents").alias("_n"),
                                   F.count("transaction_id").alias("total_transactions"))
    return g.select("shop_name", cents_to_amount("_s").alias("total_revenue"),
                    avg_amount("_s", "_n").alias("avg_sale_value"),
                    "total_transactions").orderBy(F.desc("total_revenue"), "shop_name")


def revenue_by_weekday_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: revenue and count per weekday name on the loaded processed table."""
    p = models(spark, sf_dir).processed()
    g = p.groupBy("day_of_week").agg(F.sum("total_cents").alias("_s"),
                                     F.count("transaction_id").alias("transactions"))
    return g.select("day_of_week", cents_to_amount("_s").alias("revenue"),
                    "transactions").orderBy(F.desc("revenue"))


# ---- cleaning job --------------------------------------------------------------

def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1–B3, C1–C4 on the dirty fixture (raw text → typed → clean)."""
    typed = cl.parse_raw(fixture.raw_text_transactions(spark, sf_dir, dirty=True))
    c = cl.clean(typed, FIXTURE)
    return c.select("transaction_id", "date", "time", "shop_id", "shop_name", "city",
                    "product_name", "category", "quantity", "unit_price",
                    "total_amount", "customer_id", "payment_method")


def dedup_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per transaction id, the first in the fixed total order."""
    return cl.deduplicated(fixture.typed_transactions(spark, sf_dir))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: rows per reject reason on the dirty fixture."""
    return cl.reason_counts(fixture.dirty_transactions(spark, sf_dir), FIXTURE)


def row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw / non-null / deduplicated / clean / removed counts, one row."""
    return cl.row_audit(fixture.dirty_transactions(spark, sf_dir), FIXTURE)


def enriched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived calendar and band columns of the processed table."""
    p = models(spark, sf_dir).processed()
    return p.select("transaction_id", "date", "day_of_week", "month_name", "year",
                    "month_number", "is_weekend", "revenue_category", "total_amount")


def stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging view over the loaded processed table."""
    return _public(models(spark, sf_dir).stg())


# ---- models --------------------------------------------------------------------
# Each model is computed here from the staging view over the written processed
# table (as the reference builds its models from the loaded table); the serving
# queries below read the written model tables instead.

def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _public(marts.daily_revenue(models(spark, sf_dir).stg()))


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = models(spark, sf_dir)
    return _public(marts.top_products(ms.stg(), ms.products()))


def shop_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = models(spark, sf_dir)
    return _public(marts.shop_performance(ms.stg(), ms.products()))


# ---- incremental refresh ---------------------------------------------------------

_REFRESHED: dict = {}


def _refreshed(spark, sf_dir) -> refresh.IncrementalMarts:
    """Marts built from a processed table whose May 1998 has wrong amounts and which lacks
    July 1997; then an increment brings both months and those two are refreshed."""
    ms = models(spark, sf_dir)
    if _REFRESHED.get(sf_dir, (None,))[0] is not ms:
        src, root = ms.processed(), scratch_path(spark, "refresh")
        may = (F.col("year") == 1998) & (F.col("month_number") == 5)
        july = (F.col("year") == 1997) & (F.col("month_number") == 7)
        wrong = F.col("total_cents") + F.when(may, 1).otherwise(0)
        files.write_processed(src.filter(~july).withColumn("total_cents", wrong), f"{root}/processed")
        job = refresh.IncrementalMarts(spark, f"{root}/processed", f"{root}/marts").refresh()
        increment = src.filter(may | july)
        files.write_processed(increment, job.processed, increment=True)
        job.refresh(refresh.touched_months(increment))
        _REFRESHED[sf_dir] = (ms, job)
    return _REFRESHED[sf_dir][1]


def refreshed_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + E1: daily_revenue after the refresh of two months."""
    return _public(_refreshed(spark, sf_dir).daily_revenue())


def refreshed_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + E2: top_products merged from the months' partials."""
    return _public(_refreshed(spark, sf_dir).top_products())


def refreshed_shop_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + E3: shop_performance merged from the months' partials."""
    return _public(_refreshed(spark, sf_dir).shop_performance())


def customers_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E15 + T6: distinct customers per shop and month, per shop and in all, from the
    daily sketches; whether each estimate lies within four standard errors (and one
    customer) of the exact count, which is given."""
    job = _refreshed(spark, sf_dir)
    days, stg = job.days(), models(spark, sf_dir).stg()
    out = None
    count = F.countDistinct("customer_id")
    for level, by in (("month", ["shop_id", "year", "month_number"]), ("shop", ["shop_id"]), ("all", [])):
        part = refresh.customers_approx(days, by)
        if by:
            exact = stg.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(count.alias("exact_customers"))
            part = part.join(exact, same_as([(c, f"_{c}") for c in by]))
        else:
            part = part.withColumn("exact_customers", stg.select(count).scalar())
        part = part.select(
            F.lit(level).alias("level"),
            *[(F.col(c) if c in by else F.lit(None).cast(t)).alias(c)
              for c, t in (("shop_id", "string"), ("year", "int"), ("month_number", "int"))],
            "exact_customers",
            (F.abs(F.col("customers_approx") - F.col("exact_customers"))
             <= F.col("exact_customers") * (4 * refresh.ERROR) + 1).alias("within_error"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- serving -------------------------------------------------------------------

# Serving queries read the materialised model tables (written once per session
# and data folder), as the reference's API reads its warehouse tables.

def _stg(spark, sf_dir):
    return models(spark, sf_dir).stg()


def _shop_mart(spark, sf_dir):
    return models(spark, sf_dir).shop()


def _daily(spark, sf_dir):
    return models(spark, sf_dir).daily()


def _top(spark, sf_dir):
    return models(spark, sf_dir).top()


def shops(spark, sf_dir):
    return serving.shops(_shop_mart(spark, sf_dir))


def report_shops(spark, sf_dir):
    return serving.report_shops(_shop_mart(spark, sf_dir))


def shop_by_id(spark, sf_dir):
    """V2 with a lower-case argument that must fold to upper case."""
    return _public(serving.shop_by_id(_shop_mart(spark, sf_dir), "shop000007"))


def recent_daily(spark, sf_dir):
    return serving.recent_daily(_daily(spark, sf_dir), 100)


def revenue_by_weekday(spark, sf_dir):
    return serving.revenue_by_weekday(_daily(spark, sf_dir))


def weekday_reindexed(spark, sf_dir):
    return serving.weekday_reindexed(_daily(spark, sf_dir))


def top5_products_per_shop(spark, sf_dir):
    return serving.top_products_per_shop(_top(spark, sf_dir), 5)


def top3_products_per_shop(spark, sf_dir):
    return serving.top_products_per_shop(_top(spark, sf_dir), 3)


def top_products_from_sums(spark, sf_dir):
    return serving.top_products_from_sums(models(spark, sf_dir).products(), 5)


def portfolio_summary(spark, sf_dir):
    return serving.portfolio_summary(_shop_mart(spark, sf_dir))


def portfolio_summary_true(spark, sf_dir):
    return serving.portfolio_summary_true(_stg(spark, sf_dir), _shop_mart(spark, sf_dir))


def shop_bars(spark, sf_dir):
    return serving.shop_bars(_shop_mart(spark, sf_dir))


def formatted_shops(spark, sf_dir):
    return serving.formatted_shops(_shop_mart(spark, sf_dir))


# ---- report metrics, spine, seasonal adjustment --------------------------------

def value_mix(spark, sf_dir):
    return metrics.value_mix(_shop_mart(spark, sf_dir))


def weekend_share(spark, sf_dir):
    return metrics.weekend_share(_shop_mart(spark, sf_dir))


def peer_ratio(spark, sf_dir):
    return metrics.peer_ratio(_shop_mart(spark, sf_dir))


def bottom_products(spark, sf_dir):
    return metrics.bottom_products(_top(spark, sf_dir))


def top_products_overall(spark, sf_dir):
    return metrics.top_products_overall(_top(spark, sf_dir), 5)


def customers_per_shop(spark, sf_dir):
    return metrics.customers_per_shop(_shop_mart(spark, sf_dir), _stg(spark, sf_dir))


def insight_context(spark, sf_dir):
    return metrics.insight_context(_shop_mart(spark, sf_dir), _top(spark, sf_dir),
                                   _daily(spark, sf_dir), 3)


def calendar_spine_daily(spark, sf_dir):
    return _public(metrics.calendar_spine_daily(_daily(spark, sf_dir)))


def revenue_by_weekday_filled(spark, sf_dir):
    return metrics.revenue_by_weekday_filled(_daily(spark, sf_dir))


def seasonally_adjusted_daily(spark, sf_dir):
    return metrics.seasonally_adjusted_daily(_daily(spark, sf_dir))


# ---- data quality ---------------------------------------------------------------

def quality_unique(spark, sf_dir):
    """Q1 on the raw fixture: repeated transaction ids (the duplicates to remove)."""
    return quality.unique_violations(fixture.typed_transactions(spark, sf_dir),
                                     "transaction_id")


def quality_not_null(spark, sf_dir):
    """Q2 on the dirty fixture: NULL count of each critical column."""
    return quality.null_counts(fixture.dirty_transactions(spark, sf_dir),
                               CRITICAL_COLUMNS)


def quality_amount(spark, sf_dir):
    """Q4 on the processed table: totals that differ from price × quantity."""
    return quality.amount_violations(models(spark, sf_dir).processed())


# ---- sources and sinks ------------------------------------------------------------

_LOADED = [c for c in PROCESSED_COLUMNS if c != "total_cents"]  # the 20 delivered columns


def _stamped(df: DataFrame) -> DataFrame:
    """The load time differs from run to run: only whether it came through is compared."""
    return df.withColumn("processed_timestamp", F.col("processed_timestamp").isNotNull())


def variant_load(spark, sf_dir):
    """A5 + A6: processed rows → one variant object each → the 20 typed columns again."""
    src = models(spark, sf_dir).processed().select(*_LOADED)
    stage = written(files.to_variant_stage(src), "variant_stage")
    return _stamped(files.from_variant_stage(stage, src.schema))


def _json_stage(spark, sf_dir):
    """Processed rows as JSON text, cut off in the middle where the cents end in 7."""
    src = models(spark, sf_dir).processed()
    line = F.to_json(F.struct(*[F.col(c) for c in _LOADED]))
    broken = F.when(F.col("total_cents") % 10 == 7, F.substring(line, 1, 40)).otherwise(line)
    path = scratch_path(spark, "json_lines")
    src.select(broken.alias("value")).write.text(path)
    return src, files.parse_json_stage(spark.read.text(path))


def json_load(spark, sf_dir):
    """A5 with bad records: JSON text lines are staged, malformed ones are skipped."""
    src, stage = _json_stage(spark, sf_dir)
    return _stamped(files.from_variant_stage(files.loaded(stage), src.select(*_LOADED).schema))


def json_load_audit(spark, sf_dir):
    """A5: how many records were loaded and how many were rejected."""
    _, stage = _json_stage(spark, sf_dir)
    return stage.agg(F.count(F.lit(1)).alias("n_lines"),
                     F.count_if(F.col("raw_data").isNotNull()).alias("n_loaded"),
                     F.count_if(F.col("raw_data").isNull()).alias("n_rejected"))


_LOADS: dict = {}


def _folder_load(spark, sf_dir) -> loads.FolderLoad:
    """Processed rows landed as JSON text in a folder per year, broken off in the middle
    where the cents end in 7. The years up to 1997 are loaded, loaded again, and then
    1998 and a folder with a file that is no Parquet; the later years never land."""
    ms = models(spark, sf_dir)
    src = ms.processed()
    if _LOADS.get(sf_dir, (None,))[0] is not ms:
        root = scratch_path(spark, "folder_load")
        line = F.to_json(F.struct(*[F.col(c) for c in _LOADED]))
        broken = F.when(F.col("total_cents") % 10 == 7, F.substring(line, 1, 40)).otherwise(line)
        text = src.select(broken.alias("value"), F.col("year").alias("landed"))
        job = loads.FolderLoad(spark, f"{root}/landing", f"{root}/state", "parquet",
                               text.select("value").schema, "value")
        for years, folder in (("landed <= 1997", "first"), ("landed = 1998", "second")):
            (text.filter(years).repartitionByRange("landed", "value").write.partitionBy("landed")
             .parquet(f"{job.landing}/{folder}"))
            if folder == "second":
                spark.range(1).select(F.lit("no parquet")).write.text(f"{job.landing}/odd/landed=0")
            job.load()
            job.load()
        _LOADS[sf_dir] = (ms, job)
    return _LOADS[sf_dir][1]


def load_record(spark, sf_dir):
    """A5 + A14 + T9: what the load record holds: rows loaded and rejected by load,
    landed folder and status."""
    r = _folder_load(spark, sf_dir).record()
    year = F.regexp_extract("file", "landed=(\\d+)", 1).cast("int")
    return r.groupBy("load_id", year.alias("landed"), "status").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))


def load_rows(spark, sf_dir):
    """A5 + A6: the typed rows after all loads, each once."""
    src = models(spark, sf_dir).processed().select(*_LOADED)
    return _stamped(_folder_load(spark, sf_dir).typed(src.schema))


def csv_roundtrip(spark, sf_dir):
    """A1 + H2: the dirty fixture written as CSV text, read back with every column as
    text, parsed and cleaned (must equal clean_transactions; no line is malformed)."""
    path = scratch_path(spark, "raw_csv")
    files.write_raw_csv(fixture.raw_text_transactions(spark, sf_dir, dirty=True), path)
    raw = files.read_raw_csv(spark, path)
    typed = cl.parse_raw(raw.filter(F.col("_corrupt_record").isNull()))
    c = cl.clean(typed, FIXTURE)
    return c.select("transaction_id", "date", "time", "shop_id", "shop_name", "city",
                    "product_name", "category", "quantity", "unit_price",
                    "total_amount", "customer_id", "payment_method")


def csv_messy(spark, sf_dir):
    """B1 + A1 + T1: files with messy headers, other date forms, quantities that are no
    numbers and lines that do not fit the header. Per outcome the number of lines:
    `malformed`, then the reject reasons of the rest."""
    path = scratch_path(spark, "messy_csv")
    files.write_raw_csv(fixture.messy_transactions(spark, sf_dir), path, quote=False)
    raw = files.read_raw_csv(spark, path)
    typed = cl.parse_raw(raw.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record"))
    reasons = cl.reason_counts(typed, FIXTURE).withColumnRenamed("reject_reason", "outcome")
    # a raw column beside the corrupt one: Spark refuses queries on the latter alone
    bad = raw.filter(F.col("_corrupt_record").isNotNull()).agg(
        F.count("shop_id").alias("n_rows")).select(F.lit("malformed").alias("outcome"), "n_rows")
    return reasons.unionByName(bad)


def parquet_roundtrip(spark, sf_dir):
    """A3 + A4: processed rows written partitioned by (year, month) and read back."""
    src = models(spark, sf_dir).processed()
    path = scratch_path(spark, "processed_parquet")
    files.write_processed(src, path)
    back = files.read_processed(spark, path, src.schema)
    return _stamped(back.select(*_LOADED))


def shop_partitioned(spark, sf_dir):
    """The dirty raw rows written as one CSV folder per shop, read back and parsed:
    every row, blanks before ids included. A malformed line would be missing here."""
    path = scratch_path(spark, "raw_by_shop")
    files.write_raw_csv_by_shop(fixture.raw_text_transactions(spark, sf_dir, dirty=True), path)
    raw = files.read_raw_csv_by_shop(spark, path)
    return cl.parse_raw(raw.filter(F.col("_corrupt_record").isNull()))


def idempotent_load(spark, sf_dir):
    """J5 + A3 (batch form): a first load with wrong amounts; a second with the right ones
    that no longer has July 1997 replaces it whole; an increment of May 1998, loaded
    twice, replaces that month alone. Totals per month."""
    src = models(spark, sf_dir).processed()
    path = scratch_path(spark, "idempotent")
    files.write_processed(src.withColumn("total_cents", F.col("total_cents") + 1), path)
    files.write_processed(src.filter("NOT (year = 1997 AND month_number = 7)"), path)
    may = src.filter("year = 1998 AND month_number = 5 AND quantity > 10")
    for _ in range(2):
        files.write_processed(may, path, increment=True)
    back = files.read_processed(spark, path, src.schema)
    return back.groupBy("year", "month_number").agg(
        F.count(F.lit(1)).alias("n_rows"),
        cents_to_amount(F.sum("total_cents")).alias("total_amount"))


def json_sink(spark, sf_dir):
    """The shop list written as JSON files with lower-case keys and read back."""
    rows = serving.shops(_shop_mart(spark, sf_dir))
    path = scratch_path(spark, "shops_json")
    files.write_json(rows.toDF(*[c.upper() for c in rows.columns]), path)
    return spark.read.schema(rows.schema).json(path)


def text_sink(spark, sf_dir):
    """The report's lines written as plain text and read back."""
    path = scratch_path(spark, "report_text")
    files.write_text_report(report_lines(spark, sf_dir).select("line"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def shops_json(spark, sf_dir):
    """The `/shops` rows as JSON records (money as 2-dp decimals)."""
    rows = serving.shops(_shop_mart(spark, sf_dir))
    money = {"total_revenue", "avg_transaction_value", "revenue_per_customer",
             "weekend_revenue", "weekday_revenue", "card_payment_pct",
             "pct_of_total_revenue"}
    typed = rows.select(*[F.col(c).cast("decimal(20,2)").alias(c) if c in money else c
                          for c in rows.columns])
    return files.json_records(typed).select(
        F.get_json_object("json", "$.shop_id").alias("shop_id"), "json")


def report_lines(spark, sf_dir):
    """One text line per shop for the plain-text report (one projection)."""
    m = _shop_mart(spark, sf_dir)
    return m.select("shop_id", F.concat_ws(
        " | ", F.concat(F.lit("#"), F.col("revenue_rank").cast("string")), "shop_name",
        "city", fmt.currency_0dp(to_cents("total_revenue")),
        fmt.percent_1dp(to_cents("pct_of_total_revenue"))).alias("line"))


# ---- named layers in the catalog ---------------------------------------------------

def _published(spark, sf_dir) -> warehouse.Warehouse:
    """The folder's own warehouse, published again whenever its model set is new: the
    prefix is made from the folder's path, so folders do not share tables."""
    ms = models(spark, sf_dir)
    if ms.warehouse is None:
        mark = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:10]
        ms.warehouse = warehouse.Warehouse(
            spark, f"tillroll_{mark}", scratch_path(spark, "warehouse")).publish(ms)
    return ms.warehouse


def warehouse_revenue_by_shop(spark, sf_dir):
    """A7 + A8 + A10 + E4: the ad-hoc revenue query on the named table
    `transactions` of the raw layer, declared by DDL and loaded by overwrite."""
    t = _published(spark, sf_dir).source("raw", "transactions")
    g = t.groupBy("shop_name").agg(F.sum("total_cents").alias("_s"),
                                   F.count("total_cents").alias("_n"),
                                   F.count("transaction_id").alias("total_transactions"))
    return g.select("shop_name", cents_to_amount("_s").alias("total_revenue"),
                    avg_amount("_s", "_n").alias("avg_sale_value"), "total_transactions")


def warehouse_shop_performance(spark, sf_dir):
    """A10: the published `shop_performance` table of the marts layer."""
    return _public(_published(spark, sf_dir).source("marts", "shop_performance"))


def warehouse_shop_reconciliation(spark, sf_dir):
    """A10: revenue per shop by days, products and shop mart from the bucketed tables."""
    return _published(spark, sf_dir).shop_reconciliation()


_LOOKUPS: dict = {}


def customer_history(spark, sf_dir):
    """C6 + V2: one customer's sales from a table sorted on the transaction id, where
    Bloom filters tell which row groups hold the customer."""
    ms = models(spark, sf_dir)
    src = ms.processed()
    if _LOOKUPS.get(sf_dir, (None,))[0] is not ms:
        path = scratch_path(spark, "lookup")
        files.write_lookup(src, path, "transaction_id", ["customer_id", "shop_id"])
        _LOOKUPS[sf_dir] = (ms, path)
    return files.lookup(spark, _LOOKUPS[sf_dir][1], src.schema, "customer_id", "CUST000007").select(
        "transaction_id", "date", "shop_id", "product_name", cents_to_amount("total_cents").alias("total_amount"))


def column_contract(spark, sf_dir):
    """Q5: the documented columns against the catalog's comments; problem NULL = kept."""
    columns = _published(spark, sf_dir).columns("raw", "transactions")
    return quality.documentation_gaps(columns, SOURCE_DOCS)


# ---- streaming -------------------------------------------------------------------

_STREAMS: dict = {}
# The fixture's events span 30 days and the second landing replays rows from the
# whole span, so the watermark delay must cover it.
# The state's partitions follow the events table's size (`_sized`), four at least.
_FIXTURE_STREAM = ingest.StreamConfig(watermark="40 days", state_partitions=4)


_LATE_STREAM = ingest.StreamConfig(watermark="1 day", state_partitions=4)


def _sized(cfg: ingest.StreamConfig, state: tuple[int, int, int]) -> ingest.StreamConfig:
    return replace(cfg, state_partitions=ingest.state_partitions(state[1], cfg.state_partitions))


def _replayed(spark, sf_dir, cfg=_FIXTURE_STREAM):
    state = folder_state(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), cfg)
    if key not in _STREAMS or _STREAMS[key][0] != state:
        if key in _STREAMS:
            discard(spark, _STREAMS[key][1].root)
        _STREAMS[key] = (state, ingest.replay_fixture(spark, sf_dir, _sized(cfg, state)))
    return _STREAMS[key][1]


def stream_dedup(spark, sf_dir):
    """J1 + J2: events landed twice with overlap, cleaned and de-duplicated by
    two incremental runs; the silver table holds every event once."""
    job = _replayed(spark, sf_dir)
    s = spark.read.schema(job.silver_schema()).parquet(job.silver)
    return s.select("transaction_id", "date", "shop_id", "customer_id",
                    cents_to_amount("total_cents").alias("total_amount"),
                    "day_of_week", "is_weekend")


def stream_daily(spark, sf_dir):
    """J3 + J5: one-day windows per shop from the silver stream, written per
    micro-batch idempotently; newest version of each window."""
    return ingest.stream_daily_result(_replayed(spark, sf_dir))


_SLICED: dict = {}
# copies land a slice of a sixth of the span late: the watermark covers two of them
_SLICE_STREAM = ingest.StreamConfig(watermark="11 days", state_partitions=4)


def _sliced(spark, sf_dir):
    state = folder_state(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SLICED or _SLICED[key][0] != state:
        _SLICED[key] = (state, ingest.replay_in_slices(spark, sf_dir, _sized(_SLICE_STREAM, state), 6,
                                                       ordered=True))
    return _SLICED[key][1]


def stream_ordered_dedup(spark, sf_dir):
    """J2 + C2: of every event's copies the first in the fixed order, though another came
    first; the rows that the watermark has passed."""
    job = _sliced(spark, sf_dir)
    s = spark.read.schema(job.silver_schema()).parquet(job.silver)
    return s.select("transaction_id", "date", "shop_id", "customer_id",
                    cents_to_amount("total_cents").alias("total_amount"))


def stream_customers(spark, sf_dir):
    """Exact distinct customers per closed day and shop, by chained stateful
    operators over the de-duplicated stream."""
    job = _sliced(spark, sf_dir)
    c = spark.read.schema("window_start timestamp, window_end timestamp, shop_id string, "
                          "customers long").parquet(job.customers)
    day = F.date_add(F.lit("1970-01-01").cast("date"),
                     F.floor(F.unix_seconds("window_start") / 86400).cast("int"))
    return c.select(day.alias("window_date"), "shop_id", "customers")


def stream_late(spark, sf_dir):
    """A second landing whose new events are mostly older than the watermark: the
    rows that silver refused, from the side table."""
    job = _replayed(spark, sf_dir, _LATE_STREAM)
    late = spark.read.schema(job.silver_schema()).parquet(job.late)
    return late.select("transaction_id", "date", "shop_id", "customer_id",
                       cents_to_amount("total_cents").alias("total_amount"))


QUERIES = {
    "revenue_by_shop": revenue_by_shop,
    "revenue_by_weekday_raw": revenue_by_weekday_raw,
    "clean_transactions": clean_transactions,
    "dedup_transactions": dedup_transactions,
    "reject_reasons": reject_reasons,
    "row_audit": row_audit,
    "enriched_transactions": enriched_transactions,
    "stg_transactions": stg_transactions,
    "daily_revenue": daily_revenue,
    "top_products": top_products,
    "shop_performance": shop_performance,
    "refreshed_daily_revenue": refreshed_daily_revenue,
    "refreshed_top_products": refreshed_top_products,
    "refreshed_shop_performance": refreshed_shop_performance,
    "customers_approx": customers_approx,
    "shops": shops,
    "report_shops": report_shops,
    "shop_by_id": shop_by_id,
    "recent_daily": recent_daily,
    "revenue_by_weekday": revenue_by_weekday,
    "weekday_reindexed": weekday_reindexed,
    "top5_products_per_shop": top5_products_per_shop,
    "top3_products_per_shop": top3_products_per_shop,
    "top_products_from_sums": top_products_from_sums,
    "portfolio_summary": portfolio_summary,
    "portfolio_summary_true": portfolio_summary_true,
    "shop_bars": shop_bars,
    "formatted_shops": formatted_shops,
    "value_mix": value_mix,
    "weekend_share": weekend_share,
    "peer_ratio": peer_ratio,
    "bottom_products": bottom_products,
    "top_products_overall": top_products_overall,
    "customers_per_shop": customers_per_shop,
    "insight_context": insight_context,
    "calendar_spine_daily": calendar_spine_daily,
    "revenue_by_weekday_filled": revenue_by_weekday_filled,
    "seasonally_adjusted_daily": seasonally_adjusted_daily,
    "quality_unique": quality_unique,
    "quality_not_null": quality_not_null,
    "quality_amount": quality_amount,
    "variant_load": variant_load,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "shop_partitioned": shop_partitioned,
    "idempotent_load": idempotent_load,
    "shops_json": shops_json,
    "report_lines": report_lines,
    "warehouse_revenue_by_shop": warehouse_revenue_by_shop,
    "warehouse_shop_performance": warehouse_shop_performance,
    "warehouse_shop_reconciliation": warehouse_shop_reconciliation,
    "customer_history": customer_history,
    "stream_dedup": stream_dedup,
    "stream_daily": stream_daily,
    "stream_ordered_dedup": stream_ordered_dedup,
    "stream_customers": stream_customers,
    "stream_late": stream_late,
    "json_load": json_load,
    "json_load_audit": json_load_audit,
    "load_record": load_record,
    "load_rows": load_rows,
    "csv_messy": csv_messy,
    "json_sink": json_sink,
    "text_sink": text_sink,
    "column_contract": column_contract,
}
