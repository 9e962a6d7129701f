"""Secret scans: known forms and a battery of randomness tests, in SQL functions only.

Three base forms are found by pattern in every whole text (see ``BASE``): assignments of
a password-like name, access keys, and long lower-case hex. Beside them every run of
``RUN`` or more code characters is a candidate, tested as follows.

* Encoding: the smallest alphabet that covers the run (hex, base 32, 36, 62, 64).
* Battery, under "the symbols are drawn uniformly": chi-squared over the alphabet, the
  Wald-Wolfowitz runs test about the alphabet's middle, lag-1 serial correlation. A run
  that any of them rejects beyond ``REJECT`` standard deviations is not random.
* Length-aware false-discovery control: against "the run is text" (letters as uneven as
  in prose) chi-squared is non-central with a non-centrality that grows with the length,
  so a short run gives a weak p-value and a long one a strong one. Benjamini-Hochberg at
  ``RATE`` over all candidates of the table sets the p-value up to which random runs are
  reported. P-values are first rounded up to one of a fixed number of bins, so the
  procedure needs one small table of bin counts.

Offsets are code points, end exclusive. They come from the lengths of the pieces between
matches, summed by a window over a document's matches.

Defined cases: NULL text is empty; documents without a find have zero counts, the digest
of the empty string and empty spans; repeated rows are scanned each; very long texts are
scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.materialize import written
from .common import text_of

#: kind, pattern, value group, least length of the value
BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"([A-Za-z0-9+/_.=-]+)", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    # a run shorter than 32 can never be part of a longer match, so the length may be
    # asked for in the pattern, which spares a row for every a-f letter of a text
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
RUN = 20
CANDIDATE = ("random", rf"[A-Za-z0-9+/_-]{{{RUN},}}", 0, RUN)

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: name, class of a whole run, alphabet in order
ENCODINGS = [
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex upper", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", LOWER.upper() + "234567"),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER),
    ("base36 upper", "^[0-9A-Z]+$", DIGITS + LOWER.upper()),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + LOWER.upper() + LOWER),
    ("base64", "^[0-9A-Za-z+/]+$", LOWER.upper() + LOWER + DIGITS + "+/"),
    ("base64 url", "^[0-9A-Za-z_-]+$", LOWER.upper() + LOWER + DIGITS + "-_"),
]
REJECT = 3.3
RATE = 0.01
TEXT_COINCIDENCE = 0.065  # chance that two letters of prose are the same
BINS, DEEPEST = 16, 40  # p-value bins per power of ten, powers of ten


def _found(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Lengths of the pieces between matches, matches and their values; NULL if none."""
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else every
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    return F.when(text.rlike(pattern), F.arrays_zip(
        F.slice(gaps, 1, F.size(every)).alias("gap"),
        F.transform(every, lambda x: F.length(x)).alias("len"), value.alias("value"))
        ).alias(kind)


def matches(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(documents: tag, doc_id; matches: tag, kind, start, end, value)."""
    text = text_of(text_col)
    forms = [*BASE, CANDIDATE]
    raw = written(docs.select(
        F.monotonically_increasing_id().alias("tag"), F.col(id_col).cast("long").alias("doc_id"),
        *[_found(text, kind, pattern, group) for kind, pattern, group, _ in forms]), "secret-matches")
    rows = None
    for kind, _, _, least in forms:
        one = (raw.filter(F.col(kind).isNotNull()).select("tag", F.posexplode(kind).alias("i", "m"))
               .select("tag", F.lit(kind).alias("kind"), "i", "m.gap", "m.len", "m.value",
                       F.lit(least).alias("least")))
        rows = one if rows is None else rows.unionByName(one)
    order = Window.partitionBy("tag", "kind").orderBy("i")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
    rows = rows.filter(F.length("value") >= F.col("least")).select(
        "tag", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "value")
    return raw.select("tag", "doc_id"), rows


def _normal_cdf(z: Column) -> Column:
    """Logistic approximation, within 2e-4 and with the right order in the tails."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def tested(tokens: DataFrame) -> DataFrame:
    """Candidates with `random` (the battery rejects nothing) and `p` (against text)."""
    alphabet = F.coalesce(*[F.when(F.col("value").rlike(rx), F.lit(a)) for _, rx, a in ENCODINGS],
                          F.lit(LOWER.upper() + LOWER + DIGITS + "+/-_"))
    t = tokens.withColumn("alphabet", alphabet).withColumn("k", F.length("alphabet").cast("double"))
    t = t.withColumn("sym", F.expr("transform(split(value, ''), c -> instr(alphabet, c))"))
    t = t.withColumn("n", F.size("sym").cast("double"))
    t = t.withColumn("mean", F.expr("aggregate(sym, 0D, (s, x) -> s + x) / n"))
    t = t.withColumn("squares", F.expr(
        "aggregate(transform(array_distinct(sym), s -> size(filter(sym, x -> x = s))), 0D, "
        "(s, c) -> s + double(c) * c)"))
    t = t.withColumn("above", F.expr("aggregate(sym, 0D, (s, x) -> s + if(x > k / 2, 1, 0))"))
    t = t.withColumn("runs", F.expr(
        "1 + aggregate(zip_with(slice(sym, 1, size(sym) - 1), slice(sym, 2, size(sym) - 1), "
        "(x, y) -> if((x > k / 2) <> (y > k / 2), 1, 0)), 0, (s, x) -> s + x)"))
    t = t.withColumn("spread", F.expr("aggregate(sym, 0D, (s, x) -> s + (x - mean) * (x - mean))"))
    t = t.withColumn("lagged", F.expr(
        "aggregate(zip_with(slice(sym, 1, size(sym) - 1), slice(sym, 2, size(sym) - 1), "
        "(x, y) -> (x - mean) * (y - mean)), 0D, (s, x) -> s + x)"))
    n, k, n1 = F.col("n"), F.col("k"), F.col("above")
    df = k - 1
    chi = F.col("squares") * k / n - n
    # Wilson-Hilferty; the cube root of chi-squared over its degrees is nearly normal
    z_chi = (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    both = n1 * (n - n1)
    mean_runs = 1 + 2 * both / n
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    z_runs = F.when(var_runs > 0, (F.col("runs") - mean_runs) / F.sqrt(var_runs))
    z_lag = F.when(F.col("spread") > 0, F.col("lagged") / F.col("spread") * F.sqrt(n))
    fair = (F.col("z_chi") <= REJECT) & (F.abs("z_runs") <= REJECT) & (F.abs("z_lag") <= REJECT)
    shift = n * F.greatest(k * TEXT_COINCIDENCE - 1, F.lit(0.2))
    z_text = (chi - df - shift) / F.sqrt(2 * (df + 2 * shift))
    t = t.select("tag", "kind", "start", "end", z_chi.alias("z_chi"), z_runs.alias("z_runs"),
                 z_lag.alias("z_lag"), _normal_cdf(z_text).alias("p"))
    return t.select("tag", "kind", "start", "end", F.coalesce(fair, F.lit(False)).alias("random"), "p")


def discovered(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """Random candidates within the Benjamini-Hochberg bound (tag, kind, start, end)."""
    bin_of = F.greatest(F.ceil(F.log10(F.greatest(F.col("p"), F.lit(10.0 ** -DEEPEST))) * BINS),
                        F.lit(-DEEPEST * BINS)).cast("int")
    t = written(tested(tokens).withColumn("bin", bin_of), "tested-runs")
    bins = t.groupBy("bin").agg(F.count(F.lit(1)).alias("c"))  # at most BINS * DEEPEST + 1 rows
    up = Window.orderBy("bin")
    bins = bins.select("bin", F.sum("c").over(up).alias("i"), F.sum("c").over(Window.partitionBy()).alias("m"))
    ok = F.pow(F.lit(10.0), F.col("bin") / BINS) <= rate * F.col("i") / F.col("m")
    bound = bins.filter(ok).agg(F.max("bin").alias("bound"))
    return (t.filter("random").join(F.broadcast(bound), F.col("bin") <= F.col("bound"))
            .select("tag", "kind", "start", "end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    every, found = matches(docs, id_col, text_col)
    found = written(found, "secret-spans")
    base = found.filter(F.col("kind") != CANDIDATE[0]).drop("value")
    more = discovered(found.filter(F.col("kind") == CANDIDATE[0]), rate)
    place = F.array_position(F.array(*[F.lit(k) for k, *_ in BASE]), F.col("kind"))
    spans = base.unionByName(more).withColumn("place", F.when(place > 0, place).otherwise(len(BASE) + 1))
    label = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    item = F.struct("start", "place", "end", label.alias("label"))

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(items), lambda x: x["label"]), ",")

    per_doc = spans.groupBy("tag").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k, *_ in BASE],
        joined(F.collect_list(F.when(F.col("place") <= len(BASE), item))).alias("base"),
        joined(F.collect_list(item)).alias("spans"))
    out = every.join(per_doc, "tag", "left")
    return out.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k, *_ in BASE],
                      F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))
