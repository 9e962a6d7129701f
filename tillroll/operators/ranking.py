"""Ranks and shares for tables and groups of any size, in one plan.

``RANK() OVER (PARTITION BY g ORDER BY v)`` gathers a whole group (without ``g`` the whole
table) in one task. `ranks` works on counted values instead:

1. rows are aggregated to (group, value) with their number, so ties collapse on the map
   side before anything is shuffled;
2. quantiles of the value cut the value axis into as many ranges as there are shuffle
   partitions; within a (group, range) a window adds up the rows that come before a value.
   No window task holds more than one range of one group;
3. the sums per (group, range), at most one row per range and group, give by a second
   window the rows in earlier ranges;
4. the rank, rows before plus one, is joined back on (group, value). A value that most
   rows share is one row on the rank side and a splittable key on the other.

Shares of a grand total use a scalar subquery (one value), not a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the quantiles: a range is off by one in ACCURACY rows


def same_as(pairs: list[tuple[str, str]]) -> Column:
    """NULL-safe equality of all column pairs."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def ranges_below(bounds: list, value: Column) -> Column:
    """How many of the ascending `bounds` lie below a value, by binary search: about
    log2(len(bounds)) comparisons a row."""
    ends = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    # beyond the last bound `get` is NULL and the step is not taken
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.get(ends, low + step - 1) < value, low + step).otherwise(low))


def ranks(df: DataFrame, order_col: str, rank_col: str, group_cols: list[str] | None = None,
          ascending: bool = False, ranges: int | None = None) -> DataFrame:
    """The rank of every (group, value): columns `_g0`…, `_v` and `rank_col` (INT). `df`
    is read three times, once at the call: give it a written table or a small
    aggregate."""
    groups = [f"_g{i}" for i in range(len(group_cols or []))]
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / n for i in range(1, n)]
    keys = [F.col(c).alias(g) for c, g in zip(group_cols or [], groups)]
    values = df.groupBy(*keys, F.col(order_col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # at most n numbers come to the driver
    bounds = df.select(F.percentile_approx(order_col, cuts, ACCURACY)).first()[0] if cuts else None
    cut = ranges_below(sorted(set(bounds)), F.col("_v")) if bounds else F.lit(0)
    # ranges are numbered in rank order; NULLs have the last one
    cut = cut if ascending else -cut
    values = values.withColumn("_r", F.when(F.col("_v").isNull(), n + 1).otherwise(cut))

    def direction(c: str) -> Column:
        return F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last()

    def before(col: str, by: list[str], order: Column) -> Column:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(col).over(w), F.lit(0))

    inside = values.withColumn("_in", before("_n", [*groups, "_r"], direction("_v")))
    sums = values.groupBy(*groups, "_r").agg(F.sum("_n").alias("_s"))
    sums = sums.withColumn("_up", before("_s", groups, F.col("_r").asc()))
    sums = sums.select(*[F.col(c).alias(f"_s{c}") for c in [*groups, "_r"]], "_up")
    return (inside.join(sums, same_as([(c, f"_s{c}") for c in [*groups, "_r"]]))
            .select(*groups, "_v", (F.col("_in") + F.col("_up") + 1).cast("int").alias(rank_col)))


def ranked(df: DataFrame, order_col: str, rank_col: str, group_cols: list[str] | None = None,
           ascending: bool = False, ranges: int | None = None) -> DataFrame:
    """Adds `rank_col` (INT) = RANK() OVER ([PARTITION BY group_cols] ORDER BY order_col
    [ASC | DESC] NULLS LAST)."""
    r = ranks(df, order_col, rank_col, group_cols, ascending, ranges)
    on = same_as([*((c, f"_g{i}") for i, c in enumerate(group_cols or [])), (order_col, "_v")])
    return df.join(r, on).select(*[F.col(f"`{c}`") for c in df.columns], rank_col)


def top_ranked(df: DataFrame, order_col: str, rank_col: str, k: int,
               group_cols: list[str] | None = None, ascending: bool = False) -> DataFrame:
    """The rows whose RANK() within their group is at most `k`, ties kept, with the rank:
    `ranked(...)` filtered, without ranking the rest.

    A rank of at most k needs one of the k first distinct values. Rows are counted per
    (group, value), so ties collapse on the map side; every task keeps its k first values
    of a group (Spark's window group limit) and only those are shuffled to the group,
    where a running sum of the counts gives the ranks. Joined back on (group, value), a
    value that most rows share stays spread. `df` is read twice."""
    groups = [f"_g{i}" for i in range(len(group_cols or []))]
    keys = [F.col(c).alias(g) for c, g in zip(group_cols or [], groups)]
    values = df.groupBy(*keys, F.col(order_col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    order = F.col("_v").asc_nulls_last() if ascending else F.col("_v").desc_nulls_last()
    if groups:
        first = (values.withColumn("_i", F.row_number().over(Window.partitionBy(*groups).orderBy(order)))
                 .filter(F.col("_i") <= k).drop("_i"))
    else:
        first = values.orderBy(order).limit(k)
    # at most k rows a group
    before = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rank = (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("int")
    first = first.select(*groups, "_v", rank.alias(rank_col)).filter(F.col(rank_col) <= k)
    on = same_as([*((c, f"_g{i}") for i, c in enumerate(group_cols or [])), (order_col, "_v")])
    return df.join(first, on).select(*[F.col(f"`{c}`") for c in df.columns], rank_col)


def grand_total(df: DataFrame, col: str) -> Column:
    """SUM(col) over the whole DataFrame as a scalar-subquery column."""
    return df.select(F.sum(col)).scalar()


def grand_max(df: DataFrame, col: str) -> Column:
    return df.select(F.max(col)).scalar()
