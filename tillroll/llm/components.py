"""Connected components of a link table: distributed union-find by alternating stars.

Each round hooks every node's larger neighbours onto its smallest neighbour (large star),
then every node and its smaller neighbours onto the smallest (small star). Links only
ever point to smaller ids, and the table never holds more rows than it had links; it ends
as one star per component, centred at the smallest id. Minima are aggregated with
map-side partial results and written before they are joined back, so that both sides of
the join are plain exchanges whose hot nodes Spark's skew join may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.materialize import release, written


def _pairs(df: DataFrame, a, b) -> DataFrame:
    return df.select(a.alias("u"), b.alias("v")).filter("u <> v")


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new links, and the written minima they are made from."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")), "stars")
    m = F.least("m", "u")
    return _pairs(both.join(least, "u").filter("v > u"), F.col("v"), m).distinct(), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    # u is the larger end of every link here
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "stars")
    joined = edges.join(least, "u")
    return _pairs(joined, F.col("v"), F.col("m")).unionByName(
        least.select("u", F.col("m").alias("v"))).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), least


def _settled(edges: DataFrame) -> bool:
    """Whether every link points from a node without others to a centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    busy = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return busy.filter("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (columns u, v; any order, repeats
    allowed); component is the smallest node id reachable."""
    edges = written(_pairs(links, F.greatest("u", "v"), F.least("u", "v")).distinct(), "links")
    while not _settled(edges):
        for star in (_large_star, _small_star):
            new, least = star(edges)
            new = written(new, "links")
            release(edges, least)
            edges = new
    centres = edges.select("v").distinct()
    out = written(edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                   .unionByName(centres.select(F.col("v").alias("node"), F.col("v").alias("component"))),
                   "components")
    release(edges)
    return out
