"""Groups of similar sets: banded candidates, exact verification, union-find.

Nodes carry two collections of partial keys; a table key joins one of each (tensored
banding), so m + m partial keys make m * m tables. Nodes that share a key are candidates.
They share both its partial keys, so only partial keys that several nodes hold are joined
(`shared_parts`): the m * m table keys of a node unlike all others are never made.
A group that shares a key is not expanded into all pairs:

1. Groups with the same members are taken once. One order of all nodes gives every
   group its pivot, so a node meets the same pivot in most of its groups; all groups
   of a pivot are one family. Every member is verified against its pivot on whole sets,
   and verified links are joined by union-find.
2. In families that still span several components, each member is described by its
   difference D from the set R of shingles that most of the family hold. For two members
   of sizes a and b at a similarity of p percent or more, exactly

       2 (100 + p) |D1 and D2| >= W1 + W2,   W = (100 + p) |D| - (100 - p) * size.

   Members with W1 + W2 <= 0 are linked without a test; as this holds for a pair only if
   it holds for each end and the family's member of least W, links to that member suffice.
3. What is left needs common difference elements. Members of different components
   meet only if a rare element of the one is among those of the other: of two members with
   W1 <= W2 at least W1 / (100 + p) elements are shared, so one of the size * (100 - p)
   / (100 + p) + 1 rarest elements of the first is. One order, rarest first, holds for all
   members of a family, so what a pair shares lies at or behind its first common element
   in both: a meeting at an element counts only if both have enough elements left from
   there on, (W1 + W2) / (2 (100 + p)) or more. The differences are then compared exactly.

No candidate is capped, dropped or decided by chance: a pair that shares a key is left
untested only if both ends are already connected or if it cannot be similar. All steps are
DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.materialize import release, written
from .components import components


def tensored_keys(a: Column, b: Column) -> Column:
    """All table keys from two collections of partial keys, as `shared_parts` gives them."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.xxhash64(x, y))))


def shared_parts(nodes: DataFrame) -> DataFrame:
    """(node, n, a, b): of the partial keys `a` and `b` of `nodes` those that another node
    has at the same place too, with the place hashed in. Nodes that are left without one
    of either collection share no table key and are left out."""
    parts = nodes.select("node", "n", F.size("a").alias("m"),
                         F.posexplode(F.concat("a", "b")).alias("at", "part"))
    parts = parts.select("node", "n", (F.col("at") < F.col("m")).alias("first"),
                         F.xxhash64("part", "at").alias("part"))
    several = written(parts.groupBy("part").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
                      .select("part"), "several")
    side = lambda flag: F.collect_list(F.when(flag, F.col("part")))
    out = written(parts.join(several, "part").groupBy("node").agg(
        F.first("n").alias("n"), side(F.col("first")).alias("a"), side(~F.col("first")).alias("b"))
        .filter("size(a) > 0 AND size(b) > 0"), "shared-parts")
    release(several)
    return out


def similar_sizes(x: Column, y: Column, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int,
             as_set: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """The (u, v) of `pairs` whose sets overlap in `percent` of their union or more; sets
    as for `link`."""
    left = sets.select(F.col("node").alias("v"), F.col("set").alias("body_v"))
    right = sets.select(F.col("node").alias("u"), F.col("set").alias("body_u"))
    both = pairs.join(left, "v").join(right, "u").select(
        "u", "v", as_set(F.col("body_u")).alias("set_u"), as_set(F.col("body_v")).alias("set_v"))
    shared = F.size(F.array_intersect("set_u", "set_v"))
    return (both.select("u", "v", shared.alias("shared"),
                        (F.size("set_u") + F.size("set_v")).alias("total"))
            .filter(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * percent)
            .select("u", "v"))


def _families(nodes: DataFrame, keys: Column) -> DataFrame:
    """(pivot, node, n, pivot_n, c): who meets which pivot, c the largest group's size."""
    rows = nodes.select("node", F.col("n").cast("int").alias("n"), F.explode(keys).alias("key"))
    # the first shuffle carries bare keys, and only keys that are shared go on
    shared = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
                     .select("key"), "buckets")
    found = written(rows.join(shared, "key"), "members")
    order = F.xxhash64("node", F.lit(0))
    groups = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(order).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        F.min_by(F.struct(F.col("node").alias("pivot"), F.col("n").alias("pivot_n")),
                 F.struct(order, "node")).alias("p"))
    groups = written(groups.groupBy("c", "x", "y").agg(F.min("key").alias("key"), F.first("p").alias("p"))
                     .select("key", "c", "p.pivot", "p.pivot_n"), "groups")
    out = written(found.join(groups, "key").filter("node <> pivot").groupBy("pivot", "node").agg(
        F.first("n").alias("n"), F.first("pivot_n").alias("pivot_n"), F.max("c").alias("c")), "families")
    release(shared, found, groups)
    return out


def link(nodes: DataFrame, keys: Column, sets_for: Callable[[DataFrame], DataFrame], percent: int,
         as_set: Callable[[Column], Column] = lambda c: c, spent: Sequence[DataFrame] = ()) -> DataFrame:
    """(node, component) for the nodes that are linked with another.

    `nodes` has node, n (set size) and whatever `keys`, an array of longs, is made of;
    `sets_for` gives (node, set) for a table of candidate nodes. `as_set` makes a sorted
    array of hashes of a `set`: what a set is made from may take much less room, and then
    travels in its place. The written tables `spent` are discarded once nothing reads
    `nodes` any more."""
    families = _families(nodes, keys)
    release(*spent)
    close = families.filter(similar_sizes(F.col("n"), F.col("pivot_n"), percent))
    crowds = families.filter("c > 2")
    wanted = close.unionByName(crowds)
    sets = written(sets_for(wanted.select("node").unionByName(
        wanted.select(F.col("pivot").alias("node"))).distinct()), "sets")
    links = written(verified(close.select(F.col("pivot").alias("u"), F.col("node").alias("v")),
                             sets, percent, as_set), "verified")
    parts = components(links)
    rows = _open(crowds.select("pivot", "node", "n"), parts)
    release(families)
    if rows.isEmpty():
        release(rows, sets, links)
        return parts
    crowded, rows = rows, _differences(rows, sets, percent, as_set)
    release(crowded)
    least = written(rows.groupBy("pivot").agg(
        F.min("w").alias("w_least"), F.min_by("node", F.struct("w", "node")).alias("centre")), "centres")
    plain = (rows.join(least, "pivot").filter("w + w_least <= 0 AND node <> centre")
             .select(F.col("centre").alias("u"), F.col("node").alias("v")))
    tested, links = links, written(links.unionByName(plain), "links")
    release(tested, parts)
    parts = components(links)
    apart = _open(rows, parts, least)
    release(rows, least)
    more = _meetings(apart, percent)
    release(apart)
    if not more.isEmpty():
        release(parts)
        parts = components(links.unionByName(more))
    release(links, more)
    return parts


def _open(rows: DataFrame, parts: DataFrame, least: DataFrame | None = None) -> DataFrame:
    """The rows of families whose members (not counting the pivot) are of several
    components, written, with `component` and the columns of `least` by pivot, if given."""
    placed = written(rows.select("pivot", "node").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "placed")
    several = (placed.groupBy("pivot").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
               .filter("lo < hi").select("pivot"))
    about = placed.join(several, "pivot")
    about = about if least is None else about.join(least, "pivot")
    out = written(rows.join(about, ["pivot", "node"]), "open")
    release(placed)
    return out


def _differences(rows: DataFrame, sets: DataFrame, percent: int,
                 as_set: Callable[[Column], Column]) -> DataFrame:
    """(pivot, node, n, d, w): d differs from the set that most of the family hold. The
    written `sets` are discarded."""
    own = sets.select("node", F.col("set").alias("body"))
    of_pivot = sets.select(F.col("node").alias("pivot"), F.col("set").alias("pivot_body"))
    both = rows.select("pivot", "node", "n").join(own, "node").join(of_pivot, "pivot").select(
        "pivot", "node", "n", as_set(F.col("body")).alias("set"), as_set(F.col("pivot_body")).alias("pivot_set"))
    apart = written(both.select("pivot", "node", "n", F.concat(
        F.array_except("set", "pivot_set"), F.array_except("pivot_set", "set")).alias("d")), "from-pivot")
    release(sets)
    size = apart.groupBy("pivot").agg(F.count(F.lit(1)).alias("size"))
    often = (apart.select("pivot", F.explode("d").alias("h")).groupBy("pivot", "h")
             .agg(F.count(F.lit(1)).alias("held")).filter("held > 1").join(size, "pivot").filter("held * 2 > size"))
    # at most twice a member's mean difference, whatever the family's size
    turned = written(often.groupBy("pivot").agg(F.collect_list("h").alias("turned")), "turned")
    rows = apart.join(turned, "pivot", "left").withColumn("d", F.when(F.col("turned").isNull(), F.col("d")).otherwise(
        F.concat(F.array_except("d", "turned"), F.array_except("turned", "d"))))
    w = F.size("d").cast("long") * (100 + percent) - F.col("n").cast("long") * (100 - percent)
    out = written(rows.select("pivot", "node", "n", "d", w.alias("w")), "differences")
    release(apart, turned)
    return out


def _meetings(rows: DataFrame, percent: int) -> DataFrame:
    """The similar (u, v) of different components of one family, written."""
    both = 100 + percent
    single = rows.select("pivot", "node", "n", "w", "w_least", "component", F.explode("d").alias("h"))
    # only elements that members of several components hold can be common to a pair
    held = written(single.groupBy("pivot", "h").agg(
        F.count(F.lit(1)).alias("held"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo < hi").select("pivot", "h", "held"), "held")
    inside = Window.partitionBy("pivot", "node")
    at_least = lambda x: F.greatest(F.lit(1), F.ceil(x))
    ranked = single.join(held, ["pivot", "h"]).withColumn("size", F.count(F.lit(1)).over(inside)).withColumn(
        "left", F.col("size") + 1 - F.row_number().over(inside.orderBy("held", "h")))
    ranked = written(ranked.select(
        "pivot", "h", "node", "n", "w", "component", "left",
        (F.col("left") >= at_least(F.col("w") / both)).alias("probes"),
        (F.col("left") >= at_least((F.col("w") + F.col("w_least")) / (2 * both))).alias("listed"))
        .filter("probes OR listed"), "elements")
    side = lambda flag, s: ranked.filter(flag).select(
        "pivot", "h", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "w", "component", "left")])
    meet = ((F.struct("w_u", "node_u") < F.struct("w_v", "node_v"))
            & (F.col("component_u") != F.col("component_v"))
            & similar_sizes(F.col("n_u"), F.col("n_v"), percent)
            & (F.col("w_u") + F.col("w_v") <= F.least("left_u", "left_v") * (2 * both)))
    x, y = side("probes", "u"), side("listed", "v")
    pairs = written(x.join(y.withColumnRenamed("pivot", "p").withColumnRenamed("h", "g"),
                    (F.col("pivot") == F.col("p")) & (F.col("h") == F.col("g")) & meet)
             .select("pivot", F.col("node_u").alias("u"), F.col("node_v").alias("v"))
             .groupBy("u", "v").agg(F.min("pivot").alias("pivot")), "pairs")
    release(held, ranked)
    end = lambda s: rows.select("pivot", F.col("node").alias(s), F.col("d").alias(f"d_{s}"),
                                F.col("w").alias(f"w_{s}"))
    out = written(pairs.join(end("u"), ["pivot", "u"]).join(end("v"), ["pivot", "v"])
                  .filter(F.size(F.array_intersect("d_u", "d_v")) * (2 * both) >= F.col("w_u") + F.col("w_v"))
                  .select("u", "v").distinct(), "verified")
    release(pairs)
    return out
