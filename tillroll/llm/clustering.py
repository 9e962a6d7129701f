"""Centroid clustering (k-means) on bit planes.

A vector of ``WIDTH`` components becomes integers floor(SCALE * x). Bit b of all 64
components is packed into one unsigned 64-bit word, the vector's b-th bit plane, in two's
complement with as many planes as its own extremes need (the top plane weighs negative).
With planes X_b of a vector, C_d of a centroid and plane weights w, the dot product is

    sum over b, d of w_b * w_d * popcount(X_b AND C_d)

exactly, and the squared distance is |x|^2 - 2 x.c + |c|^2, each term made of popcounts.
The plane table is written once; every round is one scan of it without a shuffle of
vectors: a task hands over one row of 64 component sums and a count per cluster, the
driver sees k * 65 numbers and floors the exact means. Component sums come from the
planes too (bits set per column times the plane's weight).

Defined cases: vectors that are NULL, hold NULL or non-finite components or have another
length take no part; integer components are limited to +-2**27, so that distances fit a
long; equal distances go to the smaller centroid; a cluster without vectors keeps its
centroid; of rows that repeat an id the smaller vector is the earlier starting centroid;
rows with a NULL id take part and start last; fewer vectors than k make fewer centroids;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.materialize import written
from .topk import usable

WIDTH = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LIMIT = 1 << 27


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of a matrix of floats, limited to +-LIMIT."""
    return np.clip(np.floor(SCALE * x.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def needed(v: np.ndarray) -> np.ndarray:
    """Two's complement width of each row: bits of its largest magnitude and a sign."""
    top = np.maximum(v.max(1, initial=0), ~v.min(1, initial=0))
    return np.frexp(top.astype(np.float64))[1] + 1


def weights(width: int) -> list[int]:
    return [1 << b for b in range(width - 1)] + [-(1 << (width - 1))]


def pack(v: np.ndarray, width: int) -> np.ndarray:
    """(rows, width) planes of a (rows, 64) integer matrix."""
    return np.stack([np.packbits((v >> b & 1).astype(np.uint8), axis=1, bitorder="little")
                     .view("<u8")[:, 0] for b in range(width)], axis=1)


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of all rows of plane matrices x (n, P) and c (k, Q)."""
    out = np.zeros((len(x), len(c)), np.int64)
    for b, wb in enumerate(weights(x.shape[1])):
        for d, wd in enumerate(weights(c.shape[1])):
            out += np.bitwise_count(x[:, b, None] & c[None, :, d]).astype(np.int64) * (wb * wd)
    return out


def norms(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for b, wb in enumerate(weights(x.shape[1])):
        for d, wd in enumerate(weights(x.shape[1])):
            out += np.bitwise_count(x[:, b] & x[:, d]).astype(np.int64) * (wb * wd)
    return out


def column_sums(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """(k, 64) exact component sums by cluster, from bits set per plane and column."""
    member = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
    out = np.zeros((k, WIDTH), np.int64)
    for b, w in enumerate(weights(x.shape[1])):
        bits = np.unpackbits(np.ascontiguousarray(x[:, b]).view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        out += (member @ bits).astype(np.int64) * w
    return out


def plane_packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) to (id, planes): little-endian words, as many as the vector needs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        v = integers(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH))
        width = needed(v)
        packed = pack(v, int(width.max()))
        # planes beyond a vector's own width repeat its sign plane and are left out
        rows = [p[:w].tobytes() for p, w in zip(packed, width.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())],
                                         ["id", "planes"])


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, plane matrix) of the batch's vectors, width by width."""
    cells = batch.column(1)
    sizes = np.asarray(cells.to_pandas().str.len())
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        words = np.frombuffer(b"".join(cells.take(pa.array(at)).to_pylist()), "<u8")
        yield at, words.reshape(len(at), -1)


class Assigner:
    """Nearest centroids of plane matrices; ships to tasks as k * 64 integers."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, np.int64).reshape(-1, WIDTH)

    def nearest(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """(row numbers, planes, cluster, squared distance), width by width."""
        c = pack(self.centroids, int(needed(self.centroids).max()))
        own = norms(c)
        for at, x in _by_width(batch):
            distance = norms(x)[:, None] - 2 * products(x, c) + own[None, :]
            cluster = distance.argmin(1)
            yield at, x, cluster, distance[np.arange(len(x)), cluster]

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per cluster for the whole task: 64 sums and the count."""
        k = len(self.centroids)
        total = np.zeros((k, WIDTH + 1), np.int64)
        for batch in batches:
            for _, x, cluster, _ in self.nearest(batch):
                total[:, :WIDTH] += column_sums(x, cluster, k)
                total[:, WIDTH] += np.bincount(cluster, minlength=k)
        there = np.flatnonzero(total[:, WIDTH])
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array(total[there].tolist(), pa.list_(pa.int64()))],
            ["cluster", "sums"])

    def labels(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = np.zeros(batch.num_rows, np.int32)
            distance = np.zeros(batch.num_rows, np.int64)
            for at, _, c, d in self.nearest(batch):
                cluster[at], distance[at] = c, d
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])


def _updated(centroids: list[list[int]], planes: DataFrame) -> list[list[int]]:
    parts = planes.mapInArrow(Assigner(centroids).sums, "cluster int, sums array<long>")
    sums = (parts.select("cluster", F.posexplode("sums").alias("at", "part"))
            .groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")))
    got = {(r["cluster"], r["at"]): int(r["total"]) for r in sums.collect()}  # k * 65 numbers
    return [[got[i, j] // got[i, WIDTH] for j in range(WIDTH)] if (i, WIDTH) in got else c
            for i, c in enumerate(centroids)]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
            clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1"
            ) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every usable vector, written, and the final centroids."""
    vec = F.col(vec_col)
    rows = (vectors.filter(usable(vec) & (F.size(vec) == WIDTH))
            .select(F.col(id_col).cast("long").alias("id"), vec.cast("array<double>").alias("vec")))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "vec").limit(clusters).collect()
    centroids = integers(np.array([r["vec"] for r in first]).reshape(-1, WIDTH)).tolist()
    planes = written(rows.mapInArrow(plane_packer, "id long, planes binary"), "planes")
    if centroids:
        for _ in range(rounds):
            centroids = _updated(centroids, planes)
    labels = Assigner(centroids or [[0] * WIDTH]).labels
    return written(planes.mapInArrow(labels, "id long, cluster int, distance long"),
                   "cluster-labels"), centroids


def clustered(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
              clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, cluster_size."""
    labels, centroids = cluster(vectors, id_col, vec_col, clusters, rounds, seed)
    spark = vectors.sparkSession
    digests = spark.createDataFrame(
        [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    sizes = labels.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"),
                                          F.count(F.lit(1)).alias("cluster_size"))
    whole = labels.agg(F.sum("distance").alias("inertia"))
    # at most `clusters` rows
    info = sizes.join(digests, "cluster").withColumn("inertia", whole.scalar())
    return labels.join(F.broadcast(info), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256", "cluster_size")
