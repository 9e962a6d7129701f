"""MinHash near-dedup with tensored banding.

A document is the set of its distinct k-word shingles (A-Z lowered; fewer words than k:
the whole sequence; no words: the empty set, linked with nothing). Documents with a
Jaccard similarity of ``percent`` / 100 or more are linked; each component keeps its
smallest doc_id.

Tables: two collections of ``TABLES`` partial keys of ``ROWS`` minima each are computed,
2 * TABLES * ROWS minima in all; every pair of one key from each makes a table key of
2 * ROWS minima, TABLES ** 2 tables, for the minima of about a square root as many as
independent tables would need. A pair of similarity s is a candidate with probability
(1 - (1 - s**ROWS)**TABLES)**2: 0.9996 at 0.8, 0.99995 at 0.85, and 0.05 at 0.27, where
texts with a passage in common lie. Candidates are verified on full sets (see
``linking``).

Documents with the same set are collapsed to one node before banding, so a large group
of exact copies costs one node. Sets are 64-bit shingle hashes; two sets are taken as
equal if size, sum and exclusive-or of their mixed hashes agree.

Defined cases: NULL text is empty; NULL doc_ids form rows of their own, and a component
of NULL ids only has a NULL component_id (its rows are kept); repeated rows with one
doc_id are both reported; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.materialize import release, written
from .common import text_of
from .linking import link, shared_parts, tensored_keys
from .shingles import Hasher, batch_sets, mix

SHINGLE, PERCENT = 5, 80
TABLES, ROWS = 12, 3
_U = np.uint64


def signer(k: int, tables: int, rows: int, with_sets: bool):
    """Arrow batches of (id, text, ...) to the columns but the text, sizes and set
    checksums, with partial keys or sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(2)
        flips = rng.integers(0, 1 << 63, 2 * tables * rows, dtype=np.uint64)
        odd = rng.integers(0, 1 << 63, 2 * tables * rows, dtype=np.uint64) * _U(2) + _U(1)
        hasher = Hasher()

        def minima(h: np.ndarray) -> np.ndarray:
            if not len(h):
                return np.zeros(len(odd), _U)
            if len(h) > 20_000:
                return np.array([((h ^ f) * o).min() for f, o in zip(flips, odd)])
            return ((h ^ flips[:, None]) * odd[:, None]).min(1)

        def keys(least: np.ndarray) -> np.ndarray:
            """Of each set 2 * tables partial keys, each of `rows` minima."""
            least = least.reshape(len(least), 2 * tables, rows)
            out = np.zeros((len(least), 2 * tables), _U)
            for i in range(rows):
                out = mix(out * _U(3) + least[:, :, i])
            return out.view(np.int64)

        for batch in batches:
            sets = []
            carried = [c for i, c in enumerate(batch.columns) if i != 1]
            carried_names = [c for i, c in enumerate(batch.schema.names) if i != 1]

            def flush(start: int, sets: list) -> pa.RecordBatch:
                n = np.array([len(s) for s in sets], np.int64)
                marks = [mix(s + _U(17)) for s in sets]
                d1 = np.array([x.sum(dtype=_U) for x in marks], _U).view(np.int64)
                d2 = np.array([np.bitwise_xor.reduce(x) if len(x) else 0 for x in marks], _U).view(np.int64)
                cols = [c.slice(start, len(sets)) for c in carried]
                cols += [pa.array(n), pa.array(d1), pa.array(d2)]
                names = carried_names + ["n", "d1", "d2"]
                if with_sets:
                    flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                    cols.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat)))
                    names.append("set")
                else:
                    least = np.array([minima(s) for s in sets])
                    part = keys(least)
                    for name, half in (("a", part[:, :tables]), ("b", part[:, tables:])):
                        cols.append(pa.FixedSizeListArray.from_arrays(
                            pa.array(half.ravel()), tables).cast(pa.list_(pa.int64())))
                        names.append(name)
                return pa.RecordBatch.from_arrays(cols, names)

            start = size = 0
            for s in batch_sets(batch.column(1), k, hasher):
                sets.append(s)
                size += len(s)
                if size > 2_000_000 or len(sets) >= 4096:
                    yield flush(start, sets)
                    start, size, sets = start + len(sets), 0, []
            if sets:
                yield flush(start, sets)
    return run


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE, percent: int = PERCENT, tables: int = TABLES,
                    rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    head = "doc_id long, n long, d1 long, d2 long"
    signed = texts.mapInArrow(signer(k, tables, rows, False), head + ", a array<long>, b array<long>")
    signed = written(signed.withColumn("tag", F.monotonically_increasing_id()), "signatures")
    same = ["n", "d1", "d2"]
    classes = written(signed.filter("n > 0").groupBy(*same).agg(
        F.min("tag").alias("node"), F.min("doc_id").alias("low")), "classes")
    nodes = written(signed.select("tag", "n", "a", "b")
                    .join(classes.select(F.col("node").alias("tag")), "tag")
                    .select(F.col("tag").alias("node"), "n", "a", "b"), "nodes")
    tabled = shared_parts(nodes)
    release(nodes)

    def sets_for(wanted: DataFrame) -> DataFrame:
        # a class's set comes from the text of its smallest id, told apart by checksums
        named = classes.join(wanted, "node").select(
            "node", "low", *[F.col(c).alias(f"want_{c}") for c in same])
        there = texts.join(named, F.col("doc_id").eqNullSafe(F.col("low"))).drop("low")
        want = "node long, want_n long, want_d1 long, want_d2 long"
        made = there.select("doc_id", "text", "node", *[f"want_{c}" for c in same]).mapInArrow(
            signer(k, tables, rows, True),
            f"doc_id long, {want}, n long, d1 long, d2 long, set array<long>")
        for c in same:
            made = made.filter(F.col(c) == F.col(f"want_{c}"))
        ordinal = Window.partitionBy("node").orderBy("doc_id")
        return made.withColumn("r", F.row_number().over(ordinal)).filter("r = 1").select("node", "set")

    parts = link(tabled, tensored_keys(F.col("a"), F.col("b")), sets_for, percent, spent=[tabled])
    named = classes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = written(named.groupBy("component").agg(F.min("low").alias("component_id")), "component-ids")
    named = written(named.join(lows, "component").select(*same, "component_id"), "classes")
    release(classes, parts, lows)
    out = signed.select("doc_id", *same).join(named, same, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose document stays, columns as they were. Rows that share an
    id stay if any of them does. The texts meet the ids that go, which are the fewer: the
    planner may broadcast them and leave the texts where they are."""
    found = near_components(docs, id_col, text_col, k, percent)
    gone = (found.groupBy(F.col("doc_id").alias("gone_id")).agg(F.max("kept").alias("kept"))
            .filter("NOT kept").select("gone_id"))
    gone = written(gone, "gone-ids")
    release(found)  # the signatures and classes of `near_components`
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("row_id"))
    return rows.join(gone, F.col("row_id").eqNullSafe(F.col("gone_id")), "left_anti").select("row.*")
