"""Exact top-k inner products over an impact-ordered index, score at a time.

Components are taken as integers floor(1024 * x). Candidates are dealt into blocks of
about ``BLOCK`` vectors. A block's index holds, for every dimension, postings grouped by
quantised impact: all vectors whose component has the same level (a multiple of a step
chosen per block) form one segment; level 0 has no postings. Segments are stored by
descending impact.

A batch of queries goes through a block's segments in that order and adds up quantised
scores. After each impact level the rest of a score is bounded from both sides by what
the unprocessed levels and the quantisation error can still contribute; a vector stays
possible while its upper bound reaches the k-th best lower bound. A query stops only when
that proof has left few enough vectors, or when all segments are processed; every vector
that is still possible is rescored exactly from the integers. Nothing depends on the
stopping point but time.

Each batch of queries meets each block once (a stated query set against all rows, in
blocks); a block returns at most k rows a query and a window picks the final k. The
pairs are a Cartesian product of the two written tables: a task reads some blocks and
some batches where they lie, and neither side is shuffled, copied per partner or sent
through the driver, however many pairs there are.

Defined cases: vectors that are NULL or hold NULL or non-finite components take no part;
vectors of different lengths are compared as if padded with zeros; a query's own row is
left out by its id, so rows that repeat an id never find each other, and of several query
rows with one id the smallest vector asks; rows with a NULL id take no part; ties go to
the smaller id; integer components are limited to +-2**52 and scores to the range of a
long; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.materialize import written

SCALE = 1024
BLOCK = 4096
QUERIES = 256
LEVELS = 32
CHECK = 4
ENOUGH = 128
LIMIT = float(1 << 52)
_EXACT = 1 << 62


def integers(vec: Column) -> Column:
    """floor(SCALE * x) of each component, x as double."""
    return F.transform(vec, lambda x: F.greatest(F.lit(-LIMIT), F.least(
        F.lit(LIMIT), F.floor(x.cast("double") * SCALE).cast("double"))).cast("long"))


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x.cast("double")) < float("inf")))
    return vec.isNotNull() & F.coalesce(finite, F.lit(False))


class Index:
    """Impact-ordered postings of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.bound = int(np.abs(vectors).max(initial=0))
        self.step = max(1, -(-self.bound // LEVELS))
        levels = np.rint(vectors / self.step).astype(np.int64)
        # per dimension and level the members, largest impact first
        self.segments: list[list[tuple[int, int, np.ndarray]]] = []
        top = int(np.abs(levels).max(initial=0))
        for impact in range(top, 0, -1):
            here = []
            for sign in (1, -1):
                rows, dims = np.nonzero(levels == sign * impact)
                order = np.argsort(dims, kind="stable")
                rows, dims = rows[order], dims[order]
                cuts = np.flatnonzero(np.diff(dims)) + 1
                here += [(int(d[0]), sign * impact, r) for d, r in
                         zip(np.split(dims, cuts), np.split(rows, cuts)) if len(r)]
            self.segments.append(here)

    def search(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """(query, vector id, score) of each query's k best here."""
        n = len(self.ids)
        weight = q.astype(float)
        total = np.abs(weight).sum(1)
        acc = np.zeros((n, len(q)))
        own = np.zeros((n, len(q)), bool)
        where: dict[int, list[int]] = {i: [] for i in q_ids.tolist()}
        for r, i in enumerate(self.ids.tolist()):
            if i in where:
                where[i].append(r)
        for j, i in enumerate(q_ids.tolist()):
            own[where[i], j] = True
        live = np.arange(len(q))
        for s in range(len(self.segments) + 1):
            if s % CHECK == 0 or s == len(self.segments):
                # what unprocessed levels and rounding to levels can add or take
                rest = (len(self.segments) - s + 0.5) * self.step
                slack = total[live] * rest + 1e-9 * total[live] * (self.bound + 1) + 1
                kth = np.full(len(live), -np.inf)
                if n >= k:  # without k others the k-th is the own row's -inf
                    seen = np.where(own, -np.inf, acc)
                    kth = np.partition(seen, n - k, axis=0)[n - k]
                possible = (acc + 2 * slack >= kth) & ~own
                done = (possible.sum(0) <= max(ENOUGH, 4 * k)) | (s == len(self.segments))
                for j in np.flatnonzero(done):
                    yield from self.rescored(int(q_ids[live[j]]), q[live[j]],
                                             np.flatnonzero(possible[:, j]), k)
                if done.any():
                    live, acc, own = live[~done], acc[:, ~done], own[:, ~done]
            if not len(live):
                return
            for dim, level, rows in self.segments[s]:
                acc[rows] += weight[live, dim] * float(level * self.step)

    def rescored(self, q_id: int, q: np.ndarray, rows: np.ndarray, k: int):
        small = self.bound * int(np.abs(q).max(initial=0)) * max(1, len(q)) < _EXACT
        if small:
            scores = self.vectors[rows] @ q
        else:
            scores = np.array([sum(a * b for a, b in zip(v, q.tolist()))
                               for v in self.vectors[rows].tolist()], object)
            scores = np.array([max(-2 ** 63, min(2 ** 63 - 1, x)) for x in scores], np.int64)
        # descending by score without negating the smallest long
        order = np.lexsort((self.ids[rows], ~scores))[:k]
        for i in order:
            yield q_id, int(self.ids[rows[i]]), int(scores[i])


def _matrix(part: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    lists = part.column(part.schema.names.index(name))
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        x = x.as_py()
        out[i, :len(x)] = x
    return out


def packed(values: np.ndarray) -> bytes:
    """Little-endian integers of the least size of 1, 2, 4 and 8 bytes that holds all."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    size = next(s for s in (1, 2, 4, 8) if -(1 << (8 * s - 1)) <= low and high < 1 << (8 * s - 1))
    return values.astype(f"<i{size}").tobytes()


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    size = len(data) // max(1, rows * width) or 8
    return np.frombuffer(data, f"<i{size}").reshape(rows, width).astype(np.int64)


def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one group to one row: ids and integer components as bytes (`packed`)."""
    parts = list(batches)
    if not sum(b.num_rows for b in parts):
        return
    group = next(b.column(0)[0] for b in parts if b.num_rows)
    ids = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in parts]).astype("<i8")
    width = max((len(x) for b in parts for x in b.column(2)), default=0)
    vectors = np.concatenate([_matrix(b, "vec", width) for b in parts]).astype("<i8")
    order = np.argsort(ids, kind="stable")
    yield pa.RecordBatch.from_arrays(
        [pa.array([group.as_py()], pa.int64()), pa.array([width], pa.int64()),
         pa.array([ids[order].tobytes()], pa.binary()), pa.array([packed(vectors[order])], pa.binary())],
        ["grp", "width", "ids", "vecs"])


def searcher(k: int):
    def load(ids: pa.Scalar, vecs: pa.Scalar, width: int, wide: int):
        i = np.frombuffer(ids.as_py(), "<i8")
        v = unpacked(vecs.as_py(), len(i), width)
        return i, np.pad(v, ((0, 0), (0, wide - width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, at = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                _, qw, qi, qv, block, cw, ci, cv = [c[r] for c in batch.columns]
                qw, cw = qw.as_py(), cw.as_py()
                wide = max(qw, cw)
                if (block.as_py(), wide) != at:  # rows of a block follow each other
                    index, at = Index(*load(ci, cv, cw, wide)), (block.as_py(), wide)
                found = list(index.search(*load(qi, qv, qw, wide), k))
                a, b, c = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (a, b, c)], ["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = 10, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best among all other rows."""
    vec = F.col(vec_col)
    rows = written(vectors.filter(usable(vec) & F.col(id_col).isNotNull())
                   .select(F.col(id_col).cast("long").alias("id"), integers(vec).alias("vec"),
                           F.coalesce(is_query, F.lit(False)).alias("is_query"),
                           F.monotonically_increasing_id().alias("tag")), "vectors")
    sizes = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    blocks, batches = max(1, -(-sizes[0] // block)), max(1, -(-sizes[1] // queries))

    def grouped(df: DataFrame, n: int, salt: int) -> DataFrame:
        # the row number deals rows out, so rows that repeat an id spread as well
        df = df.select(F.pmod(F.xxhash64("tag", F.lit(salt)), F.lit(n)).alias("grp"), "id", "vec")
        return written(df.groupBy("grp").applyInArrow(
            _packed, "grp long, width long, ids binary, vecs binary"), "vector-blocks")

    c = grouped(rows, blocks, 1)
    asked = (rows.filter("is_query").groupBy("id").agg(F.min("vec").alias("vec"))
             .withColumn("tag", F.col("id")))
    q = grouped(asked, batches, 2)
    # every batch beside every block, the block's rows following each other
    pairs = c.hint("shuffle_replicate_nl").crossJoin(q.select(*[F.col(x).alias(f"q_{x}") for x in q.columns]))
    pairs = pairs.select("q_grp", "q_width", "q_ids", "q_vecs", "grp", "width", "ids", "vecs")
    found = pairs.mapInArrow(searcher(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _packed(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(list(packer(iter(table.to_batches()))))
