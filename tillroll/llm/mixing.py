"""Mixing sources to target weights by entropy balancing.

Sizes are words of a text. Each constraint group (a source) gets a token target; of
all rates r >= 0 on documents with sum(size * r) = target in every group, the one
closest in entropy to "take everything once" is r = exp(sum of the multipliers of the
document's groups). The multipliers minimise the convex dual

    sum(size * exp(lambda . x)) - sum(target * lambda)

by Newton iterations: gradient and curvature are sums over documents, computed as
Spark aggregates over cells (documents alike in all constraint columns share one rate,
so a cell is one row with its token sum). Rates are then rounded into copies: in every
cell all documents are taken floor(r) times, and documents in the order of an id hash
once more until the rest of the cell's tokens is used up. The one document in which
the rest ends is taken partly (``partial=True``: exact to the word) or rounded to the
nearest whole copy.

Defined cases: NULL text has size 0; a NULL source is a source of its own, last in
order; sources without words get target 0; a source too small for its share gets
``cap`` times its size and the excess goes to the others by weight; repeated rows count
as separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.materialize import written
from .common import text_of, word_count

CAP = 3
WEIGHTS = (1, 2, 3)
TOLERANCE = 1e-12
MAX_STEPS = 200


def document_sizes(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, grp, size, place): place is the MD5 of the id, the rounding order."""
    return written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(group_col).alias("grp"),
        word_count(text_of(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("place")),
        "mix-sizes")


def share_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(grp, tokens, target): groups by code point, NULL last, weigh `weights` in turn
    and share all tokens; targets stop at `cap` times the group's tokens.

    Capping in rounds ends where one pass in the order of cap / weight does: a group is
    capped if its cap is below its part of what the groups before it leave over. One row
    per group goes through the two windows, never documents."""
    groups = sizes.groupBy("grp").agg(F.sum("size").alias("tokens"))
    order = Window.orderBy(F.col("grp").asc_nulls_last())
    turn = F.array(*[F.lit(w).cast("long") for w in weights])
    groups = groups.withColumn("weight", F.get(
        turn, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    groups = groups.withColumn("cap", F.col("tokens") * cap)
    everyone = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("grp").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "*", F.sum("tokens").over(everyone).alias("all_tokens"),
        F.sum("weight").over(everyone).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"))
    level = ((F.col("all_tokens") - F.col("cap_before")).cast("double")
             / (F.col("all_weight") - F.col("weight_before")))
    groups = groups.withColumn("capped", F.col("cap") < F.col("weight") * level)
    left = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everyone)
    heavy = F.sum(F.when(F.col("capped"), F.lit(0)).otherwise(F.col("weight"))).over(everyone)
    even = (F.col("all_tokens") - left).cast("double") / F.nullif(heavy, F.lit(0))
    return groups.select("grp", "tokens", F.when(
        F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * even)
        .alias("target"))


def solve_rates(cells: DataFrame, constraints: dict[str, DataFrame], cap: float = CAP,
                tolerance: float = TOLERANCE) -> DataFrame:
    """Newton iterations on the dual. `cells` has the constraint columns and `tokens`;
    `constraints` maps a column to (that column, target). Returns cells with `rate`.

    One step updates each column's multipliers in turn: for a single column the Hessian
    is diagonal and the step is the full Newton step; for several, a block Newton step.
    Steps are clipped to 1, which keeps them inside the dual's basin; the loop stops
    when no target is missed by over `tolerance` of itself. The driver sees only that
    one number."""
    for j, (name, target) in enumerate(constraints.items()):
        t = target.select(F.col(name).alias(f"key{j}"), F.col("target").alias(f"target{j}"))
        cells = cells.join(t, F.col(name).eqNullSafe(F.col(f"key{j}")), "left").drop(f"key{j}")
        cells = cells.withColumn(f"lam{j}", F.lit(0.0))
    m = len(constraints)

    def rate():
        lam = F.lit(0.0)
        for i in range(m):
            lam = lam + F.col(f"lam{i}")
        return F.when(F.col("tokens") > 0, F.least(F.exp(lam), F.lit(float(cap)))).otherwise(0.0)

    cells = written(cells, "mix-cells")
    for _ in range(MAX_STEPS):
        for j, name in enumerate(constraints):
            got = F.col("tokens") * rate()
            free = F.when(rate() < cap, got).otherwise(0.0)
            sums = cells.groupBy(F.col(name).alias("key")).agg(
                F.sum(got).alias("got"), F.sum(free).alias("bend"))
            gap = F.col(f"target{j}") - F.col("got")
            curve = F.greatest(F.col("bend"), F.lit(1e-9))
            step = F.when(F.col("got") > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), gap / curve)))
            miss = F.when(F.col("got") > 0, F.abs(gap) / F.greatest(F.col(f"target{j}"), F.lit(1.0)))
            cells = (cells.join(sums, F.col(name).eqNullSafe(F.col("key")))
                     .withColumn(f"miss{j}", miss)
                     .withColumn(f"lam{j}", F.col(f"lam{j}") + F.coalesce(step, F.lit(0.0)))
                     .drop("key", "got", "bend"))
        cells = written(cells, "mix-cells")
        worst = cells.agg(F.max(F.greatest(*[F.col(f"miss{j}") for j in range(m)], F.lit(0.0)))
                          ).first()[0]
        cells = cells.drop(*[f"miss{j}" for j in range(m)])
        if not worst or worst <= tolerance:
            break
    drop = [f"{x}{j}" for j in range(m) for x in ("target", "lam")]
    return cells.withColumn("rate", rate()).drop(*drop)


def round_to_copies(sizes: DataFrame, rates: DataFrame, cap: int = CAP,
                    partial: bool = True) -> DataFrame:
    """Documents with `copies` (whole) and `part` (words of one further copy).

    The running sum over a cell's documents is cut in two so that no task holds a cell:
    sums per 16-bit prefix of the order hash give the bucket in which the cell's extra
    tokens end; only that bucket's documents go through a window."""
    want = F.least(F.round(F.round(F.col("tokens") * F.col("rate"), 4)).cast("long"),
                   F.col("tokens") * cap)
    base = F.when(F.col("tokens") > 0, F.floor(want / F.col("tokens"))).otherwise(0).cast("long")
    r = (rates.withColumn("want", want).withColumn("base", base)
         .select(F.col("grp").alias("cell"), "base",
                 (F.col("want") - F.col("base") * F.col("tokens")).alias("extra")))
    bucket = F.conv(F.substring("place", 1, 4), 16, 10).cast("long")
    docs = sizes.withColumn("bucket", bucket)
    sums = docs.groupBy("grp", "bucket").agg(F.sum("size").alias("n"))
    run = Window.partitionBy("grp").orderBy("bucket")
    ends = (sums.withColumn("upto", F.sum("n").over(run))
            .join(r, F.col("grp").eqNullSafe(F.col("cell")))
            .filter((F.col("upto") > F.col("extra")) & (F.col("upto") - F.col("n") <= F.col("extra")))
            .groupBy("cell", "base", "extra")
            .agg(F.min("bucket").alias("end_bucket"), F.min(F.col("upto") - F.col("n")).alias("used")))
    plan = written(r.select("cell", "base", "extra").join(
        ends.select(F.col("cell").alias("c2"), "end_bucket", "used"),
        F.col("cell").eqNullSafe(F.col("c2")), "left").drop("c2"), "mix-plan")
    docs = docs.join(plan, F.col("grp").eqNullSafe(F.col("cell"))).drop("cell")
    end = F.coalesce(F.col("end_bucket"), F.lit(1 << 20))  # no such bucket: everything is used
    away = docs.filter(F.col("bucket") != end).withColumn(
        "part", F.when(F.col("bucket") < end, F.col("size")).otherwise(0))
    edge = Window.partitionBy("grp").orderBy("place", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    left = F.col("extra") - F.col("used") - F.coalesce(F.sum("size").over(edge), F.lit(0))
    near = docs.filter(F.col("bucket") == end).withColumn(
        "part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    out = away.unionByName(near.select(*away.columns))
    if not partial:
        out = out.withColumn("part", F.when(F.col("part") * 2 >= F.col("size"), F.col("size"))
                             .otherwise(0))
    whole = (F.col("size") > 0) & (F.col("part") == F.col("size"))
    return (out.withColumn("copies", F.col("base") + whole.cast("long"))
            .withColumn("part", F.when(whole, F.lit(0)).otherwise(F.col("part")).cast("long"))
            .drop("bucket", "base", "extra", "end_bucket", "used"))


def mix(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
        text_col: str = "text", weights=WEIGHTS, cap: int = CAP,
        partial: bool = True) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, part, rate."""
    sizes = document_sizes(docs, id_col, group_col, text_col)
    targets = written(share_targets(sizes, weights, cap), "mix-targets")
    rates = solve_rates(targets.select("grp", "tokens"), {"grp": targets.select("grp", "target")}, cap)
    taken = round_to_copies(sizes, rates, cap, partial)
    t = (targets.join(rates.select(F.col("grp").alias("g2"), "rate"),
                      F.col("grp").eqNullSafe(F.col("g2"))).drop("g2")
         .select(F.col("grp").alias("g1"), F.col("tokens").alias("source_size"), "target", "rate"))
    return (taken.join(t, F.col("grp").eqNullSafe(F.col("g1")))
            .select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                    (F.col("copies") * F.col("size") + F.col("part")).cast("long").alias("taken"),
                    "copies", "part", "rate"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
                    text_col: str = "text", weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of `docs`, each repeated as often as the mix takes it (whole copies)."""
    m = mix(docs, id_col, group_col, text_col, weights, cap, partial=False)
    # rows that share an id have the same copies up to rounding; take the larger
    m = m.groupBy(F.col("doc_id").alias("mix_id")).agg(F.max("copies").alias("mix_copies"))
    m = written(m, "mix-copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("row_id"))
    out = rows.join(m, F.col("row_id").eqNullSafe(F.col("mix_id"))).filter("mix_copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias("copy")
                      ).select("row.*")
