"""Materialised layers: processed table → staging view → three model tables.

As in the reference's layering (processed Parquet, a staging view, tables for
the models), the cleaning job output and the models are written once and read
by every serving query, instead of re-running the cleaning plan per query. The
tables live in the shared checkpoint folder; one `ModelSet` is kept per
session, data folder and parameter set.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.materialize import discard, folder_state, reads_below, release, written
from ..params import FIXTURE, Params
from . import marts, staging

_CACHE: dict[tuple, tuple[tuple, "ModelSet"]] = {}


class ModelSet:
    def __init__(self, spark: SparkSession, sf_dir: str, p: Params = FIXTURE):
        self.spark, self.sf_dir, self.p = spark, sf_dir, p
        self._t: dict[str, DataFrame] = {}
        self.warehouse = None  # set by whoever publishes the tables to the catalog

    @classmethod
    def over(cls, processed: DataFrame, sf_dir: str, p: Params = FIXTURE) -> "ModelSet":
        """A model set whose processed table is already written."""
        ms = cls(processed.sparkSession, sf_dir, p)
        ms._t["processed"] = processed
        return ms

    def _table(self, name: str, build) -> DataFrame:
        if name not in self._t:
            self._t[name] = written(build(), name)
        return self._t[name]

    def missing(self) -> set[str]:
        """The tables that are not written yet."""
        return {"processed", "product_aggregates", "daily_revenue", "top_products",
                "shop_performance"} - set(self._t)

    def replace(self, name: str, table: DataFrame | None = None) -> None:
        """Reads a table from `table` from now on, or makes it anew when it is next asked
        for, and removes the one written so far."""
        old = self._t.pop(name, None)
        if table is not None:
            self._t[name] = table
        if old is not None:
            release(old)

    def processed(self) -> DataFrame:
        return self._table("processed",
                           lambda: staging.fixture_processed(self.spark, self.sf_dir, self.p))

    def stg(self) -> DataFrame:
        """Staging is a view (lazy) over the written processed table."""
        return staging.stg_transactions(self.processed())

    def products(self) -> DataFrame:
        """The (shop, product) aggregate that both top_products and shop_performance
        start from."""
        return self._table("product_aggregates", lambda: marts.product_aggregates(self.stg()))

    def daily(self) -> DataFrame:
        return self._table("daily_revenue", lambda: marts.daily_revenue(self.stg()))

    def forget_below(self, root: str) -> None:
        """Makes the tables that are read from files below `root` anew when they are next
        asked for, as those files are about to be replaced."""
        for name, df in list(self._t.items()):
            if reads_below(df, root):
                del self._t[name]

    def daily_dealt(self, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The daily mart dealt by `deal`, for a writer elsewhere: from its table if that is
        written, else from its sums, with no table written for it."""
        if "daily_revenue" in self._t:
            return deal(self._t["daily_revenue"])
        return marts.daily_revenue(self.stg(), deal)

    def top(self) -> DataFrame:
        return self._table("top_products", lambda: marts.top_products(
            self.stg(), self.products()))

    def shop(self) -> DataFrame:
        return self._table("shop_performance", lambda: marts.shop_performance(
            self.stg(), self.products()))

    def build_all(self, parallel: bool = True) -> "ModelSet":
        """Writes processed, then the models. With `parallel` they are submitted from
        driver threads, so the small final stages of one model share the cluster with
        the others; top_products and shop_performance start once the product aggregate
        is written."""
        self.processed()
        if not parallel:
            for build in (self.daily, self.top, self.shop):
                build()
            return self
        with ThreadPoolExecutor(max_workers=3) as pool:
            jobs = [pool.submit(self.daily)]
            self.products()
            jobs += [pool.submit(self.top), pool.submit(self.shop)]
            for f in jobs:
                f.result()
        return self


    def discard(self) -> None:
        """Drops the written tables, once newer ones have replaced them."""
        for df in self._t.values():
            for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                discard(self.spark, folder)
        self._t.clear()
        if self.warehouse is not None:
            discard(self.spark, self.warehouse.root)


TABLES = ("lineitem", "orders", "part", "supplier", "nation")


def models(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> ModelSet:
    """The model set of a data folder. New, changed or removed input files make a new
    one and drop the tables of the old."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), p)
    state = tuple(folder_state(spark, f"{key[1]}/{t}.parquet") for t in TABLES)
    if key not in _CACHE or _CACHE[key][0] != state:
        if key in _CACHE:
            _CACHE[key][1].discard()
        _CACHE[key] = (state, ModelSet(spark, sf_dir, p))
    return _CACHE[key][1]
