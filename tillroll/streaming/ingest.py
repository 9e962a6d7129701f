"""Incremental ingest of transaction files.

Two streaming queries, each run to completion with ``trigger(availableNow)``
and a checkpoint in the shared folder, so a re-run after a failure or with new
files resumes exactly where the previous run stopped:

1. *silver*: file source → typed, cleaned rows → de-duplicated on the
   transaction id within the watermark (state is dropped once the watermark
   passes, unlike an unbounded ``dropDuplicates``) → append-only Parquet sink.
2. *gold*: the silver folder as a stream → tumbling one-day windows per shop in
   ``update`` mode → ``foreachBatch`` writes each micro-batch's updated windows
   to a folder named after its batch id with overwrite. Replaying a batch
   rewrites the same folder (idempotent); readers keep the newest version of
   each window (`latest_windows`).

The event table's ``ts`` is ``TIMESTAMP_NTZ``, which watermarks reject; its wall
clock is turned into a ``TIMESTAMP`` instant read as UTC, so windows and dates
do not depend on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.money import cents_to_amount, to_cents
from ..params import Params
from ..session import scratch_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


# Gold files plus the batch folder's id, read back as a number (not as text).
GOLD_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("shop_id", T.StringType()),
    T.StructField("revenue_cents", T.LongType()),
    T.StructField("transactions", T.LongType()),
    T.StructField("min_cents", T.LongType()),
    T.StructField("max_cents", T.LongType()),
    T.StructField("approx_customers", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


# A compacted gold snapshot: newest window versions up to batch `upto`.
SNAPSHOT_SCHEMA = T.StructType(
    [f for f in GOLD_SCHEMA.fields if f.name != "batch_id"]
    + [T.StructField("upto", T.LongType())])


#: bytes of compressed input whose rows one state partition holds
STATE_BYTES = 8 << 20


@dataclass(frozen=True)
class StreamConfig:
    watermark: str = "2 days"        # how late a replayed or delayed row may arrive
    window: str = "1 day"
    copy_gap: str = "1 hour"         # how far apart the event times of an id's copies may lie
    # Bytes of input per micro-batch; None takes all that has landed. Bound it by what a
    # batch's state and shuffle may hold, not by a number of files.
    max_bytes_per_trigger: str | None = None
    # State partitions are fixed into the checkpoint when a query first starts;
    # size them to the state volume (None keeps the session's shuffle setting).
    state_partitions: int | None = None
    # RocksDB keeps large dedup / window state off the JVM heap.
    state_store: str | None = (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def state_partitions(size: int, least: int = 4) -> int:
    """State partitions for a stream over input files of `size` bytes in all: one for
    every STATE_BYTES, so that a partition's state and work stay the same as it grows."""
    return max(least, -(-size // STATE_BYTES))


class _StreamConf:
    """Applies the stream's SQL settings while a query is started, then restores."""

    def __init__(self, spark: SparkSession, cfg: "StreamConfig"):
        self.spark, self.cfg, self.saved = spark, cfg, {}

    def __enter__(self):
        want = {}
        if self.cfg.state_partitions:
            want["spark.sql.shuffle.partitions"] = str(self.cfg.state_partitions)
        if self.cfg.state_store:
            want["spark.sql.streaming.stateStore.providerClass"] = self.cfg.state_store
        for k, v in want.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def events_as_transactions(events: DataFrame, p: Params | None = None) -> DataFrame:
    """Map an event row to the transaction shape and apply the row-level cleaning
    rules (J1). Works on batch and streaming DataFrames alike."""
    # The NTZ wall clock read as UTC, whatever the session time zone is, so
    # day windows and dates do not move with the session setting.
    ts = F.col("ts")
    utc_instant = F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                   F.minute(ts), F.date_part(F.lit("SECOND"), ts),
                                   F.lit("UTC"))
    t = events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        utc_instant.alias("event_time"),
        F.col("ts").cast("date").alias("_ntz_date"),
        F.col("event_type").alias("shop_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        to_cents("value").alias("total_cents"),
    )
    t = t.filter(F.col("transaction_id").isNotNull() & F.col("event_time").isNotNull()
                 & F.col("shop_id").isNotNull() & (F.col("total_cents") > 0))
    d = F.col("_ntz_date")
    out = t.select(*[c for c in t.columns if c != "_ntz_date"], d.alias("date"),
                   cal.day_name(d).alias("day_of_week"), cal.is_weekend(d).alias("is_weekend"))
    if p is not None:
        out = out.withColumn("revenue_category", cal.revenue_category(
            cents_to_amount("total_cents"), p.low_below, p.medium_below))
    return out


def dedup_stream(tx: DataFrame, cfg: StreamConfig) -> DataFrame:
    """First arrival of each id wins; state kept only within the watermark."""
    return (tx.withWatermark("event_time", cfg.watermark)
            .dropDuplicatesWithinWatermark(["transaction_id"]))


def windowed_revenue(tx: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Per shop and one-day tumbling window: revenue, count, extremes and an
    approximate distinct customer count (`window_customers` has the exact one, after
    the window has closed)."""
    return (tx.withWatermark("event_time", cfg.watermark)
            .groupBy(F.window("event_time", cfg.window).alias("w"), "shop_id")
            .agg(F.sum("total_cents").alias("revenue_cents"),
                 F.count(F.lit(1)).alias("transactions"),
                 F.min("total_cents").alias("min_cents"),
                 F.max("total_cents").alias("max_cents"),
                 F.approx_count_distinct("customer_id").alias("approx_customers")))


def ordered_dedup(tx: DataFrame, cfg: StreamConfig) -> DataFrame:
    """J2 in C2's way: of the copies of an id the first in a fixed order (event time,
    shop, amount, customer, then the derived columns; NULLs last), whichever arrived
    first. Copies whose event times lie within `copy_gap` of each other are one session
    of the id; its least row is emitted once the watermark has passed the session, and
    its state goes. The result does not depend on how rows are dealt into batches."""
    rest = [c for c in tx.columns if c not in ("transaction_id", "event_time")]
    first = ["shop_id", "total_cents", "customer_id"]
    order = [*first, *[c for c in rest if c not in first]]
    row = F.struct("event_time", *[part for c in order for part in (
        F.col(c).isNull().alias(f"no_{c}"), F.col(c))])
    least = (tx.withWatermark("event_time", cfg.watermark)
             .groupBy(F.session_window("event_time", cfg.copy_gap), "transaction_id")
             .agg(F.min(row).alias("row")))
    return least.select(*[F.col(c) if c == "transaction_id" else F.col(f"row.{c}").alias(c)
                          for c in tx.columns])


def window_customers(tx: DataFrame, cfg: StreamConfig) -> DataFrame:
    """J3's exact distinct customers as two chained stateful operators: one row per
    (window, shop, customer), then the count per (window, shop). Both keep state only
    until the watermark passes the window's end, when the count is emitted."""
    seen = (tx.withWatermark("event_time", cfg.watermark)
            .filter(F.col("customer_id").isNotNull())
            .select(F.window("event_time", cfg.window).alias("w"), "shop_id", "customer_id")
            .dropDuplicates(["w", "shop_id", "customer_id"]))
    return seen.groupBy("w", "shop_id").agg(F.count(F.lit(1)).alias("customers")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "shop_id", "customers")


@dataclass
class IncrementalIngest:
    """Folders of one deployment: landing (input files), silver, gold, checkpoints."""
    spark: SparkSession
    landing: str
    root: str
    cfg: StreamConfig = StreamConfig()

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def _ckpt(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def _reader(self, schema: T.StructType):
        reader = self.spark.readStream.schema(schema)
        if self.cfg.max_bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", self.cfg.max_bytes_per_trigger)
        return reader

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    def write_late(self) -> None:
        """The side table of refused rows. Every clean landed row whose id silver
        does not hold came later than the watermark allowed (an id that silver holds is
        a duplicate, not a loss), so landed = silver + late counts ids exactly, however
        many micro-batches ran. One row per id; an anti-join of ids, so a re-run
        replaces the table."""
        landed = events_as_transactions(self.spark.read.schema(EVENT_SCHEMA).parquet(self.landing))
        silver = self.spark.read.schema(self.silver_schema()).parquet(self.silver)
        lost = landed.join(silver.select("transaction_id"), "transaction_id", "left_anti")
        (lost.dropDuplicates(["transaction_id"]).select(*landed.columns)
         .write.mode("overwrite").parquet(self.late))

    def _append(self, out: DataFrame, name: str, path: str):
        with _StreamConf(self.spark, self.cfg):
            q = (out.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", self._ckpt(name))
                 .trigger(availableNow=True).start(path))
            q.awaitTermination()
        return q

    def run_silver(self, ordered: bool = False):
        """Clean, de-duplicated rows; with `ordered` an id's first copy in the fixed order,
        emitted when the watermark has passed it, instead of the first to arrive."""
        src = events_as_transactions(self._reader(EVENT_SCHEMA).parquet(self.landing))
        out = (ordered_dedup if ordered else dedup_stream)(src, self.cfg)
        return self._append(out, "silver", self.silver)

    @property
    def customers(self) -> str:
        return f"{self.root}/customers"

    def run_customers(self):
        """Exact distinct customers per closed window and shop, from silver."""
        src = self._reader(self.silver_schema()).parquet(self.silver)
        return self._append(window_customers(src, self.cfg), "customers", self.customers)

    def silver_schema(self) -> T.StructType:
        return events_as_transactions(
            self.spark.createDataFrame([], EVENT_SCHEMA)).schema

    def run_gold(self):
        src = self._reader(self.silver_schema()).parquet(self.silver)
        agg = windowed_revenue(src, self.cfg)
        gold = self.gold

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            (batch.select(F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), "shop_id",
                          "revenue_cents", "transactions", "min_cents", "max_cents",
                          "approx_customers")
             .write.mode("overwrite").parquet(f"{gold}/batch_id={batch_id}"))

        with _StreamConf(self.spark, self.cfg):
            q = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
                 .option("checkpointLocation", self._ckpt("gold"))
                 .trigger(availableNow=True).start())
            q.awaitTermination()
        return q

    @property
    def snapshots(self) -> str:
        return f"{self.root}/gold_snapshots"

    def _snapshot_upto(self) -> int | None:
        """Last batch id covered by the newest snapshot (one number), or None."""
        try:
            snap = self.spark.read.schema(SNAPSHOT_SCHEMA).parquet(self.snapshots)
            return snap.agg(F.max("upto")).first()[0]
        except AnalysisException:
            return None

    def _versions(self) -> DataFrame:
        """Newest snapshot plus the batch folders written after it. Both filters
        compare a partition column with a literal, so other folders are pruned."""
        g = self.spark.read.schema(GOLD_SCHEMA).parquet(self.gold)
        upto = self._snapshot_upto()
        if upto is None:
            return g
        snap = (self.spark.read.schema(SNAPSHOT_SCHEMA).parquet(self.snapshots)
                .filter(F.col("upto") == F.lit(upto))
                .withColumnRenamed("upto", "batch_id"))
        return g.filter(F.col("batch_id") > F.lit(upto)).unionByName(snap)

    def latest_windows(self) -> DataFrame:
        """The newest version of every (window, shop): an aggregate per key, so
        a window updated in many batches costs one row per task after the
        partial step."""
        latest = self._versions().groupBy("window_start", "shop_id").agg(
            F.max_by(F.struct("window_end", "revenue_cents", "transactions", "min_cents",
                              "max_cents", "approx_customers"), "batch_id").alias("v"))
        return latest.select("window_start", "shop_id", "v.*")

    def compact(self) -> int | None:
        """Writes the newest version of every window as a snapshot folder named
        after the last batch it covers; later reads skip the older batch
        folders. Returns that batch id (None when nothing was written yet)."""
        try:
            upto = (self.spark.read.schema(GOLD_SCHEMA).parquet(self.gold)
                    .agg(F.max("batch_id")).first()[0])
        except AnalysisException:
            return None
        if upto is None or upto == self._snapshot_upto():
            return upto
        (self.latest_windows().write.mode("overwrite")
         .parquet(f"{self.snapshots}/upto={upto}"))
        return upto


def replay_fixture(spark: SparkSession, sf_dir: str, cfg: StreamConfig) -> IncrementalIngest:
    """Lands the events table as two overlapping halves in two separate runs
    (ids ending 0–8, then ids ending 8–9), so the second run replays a tenth of
    the first run's rows, and runs both stages after each landing."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    root = scratch_path(spark, "stream")
    landing = f"{root}/landing"
    job = IncrementalIngest(spark, landing, root, cfg)
    halves = [events.filter(F.col("event_id") % 10 < 9),
              events.filter(F.col("event_id") % 10 >= 8)]
    for i, half in enumerate(halves):
        (half.repartitionByRange(4, "ts").write.mode("overwrite")
         .parquet(f"{landing}/part{i}"))
        job.landing = f"{landing}/part*"
        job.run_silver()
        job.run_gold()
    job.write_late()
    return job


def replay_in_slices(spark: SparkSession, sf_dir: str, cfg: StreamConfig, slices: int,
                     ordered: bool, copies_first: bool = False) -> IncrementalIngest:
    """Lands the events in time order, one run per slice of the span. Events with ids
    ending in 8 have a copy of twice the value and another customer, which lands one
    slice after its event, or one before with `copies_first`."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    copies = events.filter(F.col("event_id") % 10 == 8).withColumn("value", F.col("value") * 2).withColumn(
        "user_id", F.col("user_id") + 1)
    low, high = events.agg(F.min(_seconds("ts")), F.max(_seconds("ts"))).first()
    width = (high - low) // slices + 1
    root = scratch_path(spark, "slices")
    job = IncrementalIngest(spark, f"{root}/landing/part*", root, cfg)
    for i in range(slices + 1):
        own, other = (i - 1, i) if copies_first else (i, i - 1)

        def within(df: DataFrame, k: int) -> DataFrame:
            at = _seconds("ts") - F.lit(low)
            return df.filter((at >= k * width) & (at < (k + 1) * width))

        (within(events, own).unionByName(within(copies, other)).write.mode("overwrite")
         .parquet(f"{root}/landing/part{i}"))
        job.run_silver(ordered)
    job.run_customers()
    return job


def _seconds(col: str) -> Column:
    """Whole seconds of a wall clock time, as if it were UTC."""
    d = F.col(col).cast("date")
    return (F.datediff(d, F.lit("1970-01-01").cast("date")).cast("long") * 86400
            + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col))


def stream_daily_result(job: IncrementalIngest) -> DataFrame:
    w = job.latest_windows()
    # UTC day of the window start from epoch seconds (no session time zone)
    day = F.date_add(F.lit("1970-01-01").cast("date"),
                     F.floor(F.unix_seconds("window_start") / 86400).cast("int"))
    return w.select(day.alias("window_date"), "shop_id",
                    cents_to_amount("revenue_cents").alias("revenue"),
                    "transactions",
                    cents_to_amount("min_cents").alias("min_transaction_value"),
                    cents_to_amount("max_cents").alias("max_transaction_value"))
