"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Every byte is embedded in ``EMBED`` numbers; ``FILTERS``
learned filters look at overlapping chunks of ``WIDTH`` bytes, ``STRIDE`` apart, that
cover the whole document; each filter's largest response over the document goes through
a ReLU and a logistic unit to one probability. Long documents are worked through in
slices, keeping only the running maxima.

The network is fitted on the driver on a bounded sample: at most ``SAMPLE`` labelled
documents of each label value, taken by an id hash, none of them held out. Their texts
are used whole, in slices. Scoring reads every document whole, inside the scan's tasks,
with no shuffle.

Defined cases: NULL text is empty, and an empty text has one chunk of padding and gets
that chunk's score; NULL labels are left out; of several labels for an id the smallest
counts; with labels of one value only every score is that value, with none 1.0; rows
with a NULL id are never held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_hash, text_of

WIDTH, STRIDE, EMBED, FILTERS = 16, 8, 8, 32
SAMPLE = 1200
EPOCHS, BATCH, RATE = 9, 64, 0.005
ACCEPT = 0.7
SLICE = 1 << 18
PAD = 256


def _chunks(codes: np.ndarray) -> np.ndarray:
    """Overlapping chunks of one padded code sequence."""
    view = np.lib.stride_tricks.sliding_window_view(codes, WIDTH)
    return view[::STRIDE]


def padded(data: np.ndarray) -> np.ndarray:
    """Codes with padding so that chunks cover all bytes; at least one chunk."""
    n = max(len(data), 1)
    steps = max(0, -(-(n - WIDTH) // STRIDE))
    out = np.full(steps * STRIDE + WIDTH, PAD, np.int16)
    out[:len(data)] = data
    return out


class Net:
    """Embedding, convolution, max-pooling and a logistic unit."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.emb = (rng.standard_normal((257, EMBED)) * 0.5).astype(f)
        self.emb[PAD] = 0
        self.w = (rng.standard_normal((WIDTH * EMBED, FILTERS)) / np.sqrt(WIDTH * EMBED)).astype(f)
        self.b = np.zeros(FILTERS, f)
        self.v = (rng.standard_normal(FILTERS) * 0.2).astype(f)
        self.c = np.zeros(1, f)

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        return self.emb[chunks].reshape(len(chunks), -1) @ self.w

    def pooled(self, docs: list[np.ndarray]) -> np.ndarray:
        """Largest response of each filter over each document's codes."""
        out = np.full((len(docs), FILTERS), -np.inf, np.float32)
        i = 0
        while i < len(docs):
            if len(docs[i]) > SLICE:
                for at in range(0, len(docs[i]) - WIDTH + 1, SLICE):
                    part = docs[i][at:at + SLICE + WIDTH - STRIDE]
                    np.maximum(out[i], self.responses(_chunks(part)).max(0), out=out[i])
                i += 1
                continue
            j, size = i, 0
            while j < len(docs) and size + len(docs[j]) <= SLICE:
                size += len(docs[j])
                j += 1
            parts = [_chunks(d) for d in docs[i:j]]
            starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
            out[i:j] = np.maximum.reduceat(self.responses(np.concatenate(parts)), starts)
            i = j
        return out

    def winners(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest response over a document's codes and the chunk that gives it."""
        top = np.full(FILTERS, -np.inf, np.float32)
        best = np.zeros((FILTERS, WIDTH), codes.dtype)
        for at in range(0, len(codes) - WIDTH + 1, SLICE):
            ch = _chunks(codes[at:at + SLICE + WIDTH - STRIDE])
            resp = self.responses(ch)
            arg = resp.argmax(0)
            here = resp[arg, np.arange(FILTERS)]
            more = here > top
            top[more], best[more] = here[more], ch[arg[more]]
        return top, best

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        h = np.maximum(self.pooled(docs) + self.b, 0)
        return 1 / (1 + np.exp(-np.clip(h @ self.v + self.c, -30, 30)))

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> "Net":
        """Adam on the balanced log loss. Gradients reach only the pooled chunks."""
        rng = np.random.default_rng(seed)
        names = ("emb", "w", "b", "v", "c")
        state = {n: [np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))] for n in names}
        share = labels.mean()
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                take = order[at:at + BATCH]
                best = np.empty((len(take), FILTERS, WIDTH), np.int64)
                top = np.empty((len(take), FILTERS), np.float32)
                for r, i in enumerate(take):
                    top[r], best[r] = self.winners(docs[i])
                pre = top + self.b
                h = np.maximum(pre, 0)
                p = 1 / (1 + np.exp(-np.clip(h @ self.v + self.c, -30, 30)))
                d = ((p - labels[take]) * weight[take] / len(take)).astype(np.float32)
                dh = np.outer(d, self.v) * (pre > 0)
                seen = self.emb[best].reshape(len(take), FILTERS, -1)
                grads = {"v": h.T @ d + 1e-4 * self.v, "c": np.array([d.sum()], np.float32),
                         "b": dh.sum(0), "w": np.einsum("rf,rfk->kf", dh, seen) + 1e-5 * self.w}
                de = (dh[:, :, None] * self.w.T[None]).reshape(len(take), FILTERS, WIDTH, EMBED)
                ge = np.zeros_like(self.emb)
                np.add.at(ge, best.ravel(), de.reshape(-1, EMBED))
                ge[PAD] = 0
                grads["emb"] = ge
                step += 1
                rate = RATE * (1 - epoch / EPOCHS)
                for n in names:
                    m, v = state[n]
                    m += 0.1 * (grads[n] - m)
                    v += 0.01 * (grads[n] ** 2 - v)
                    getattr(self, n)[...] -= (rate * (m / (1 - 0.9 ** step))
                                              / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8))
        return self


class Constant:
    def __init__(self, value: float):
        self.value = value

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        return np.full(len(docs), self.value)


def with_crops(codes: list[np.ndarray], labels: np.ndarray, seed: int = 5):
    """The sample and one random stretch of each text, so that short texts are known too."""
    rng = np.random.default_rng(seed)
    crops = []
    for c in codes:
        c = c[c != PAD]
        n = int(np.exp(rng.uniform(np.log(12), np.log(1200))))
        at = int(rng.integers(0, max(1, len(c) - n)))
        crops.append(padded(c[at:at + n]))
    return codes + crops, np.concatenate([labels, labels])


def held_out(id_col: str):
    """Documents whose labels are never learned from."""
    return F.coalesce(F.pmod(doc_hash(F.col(id_col)), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Net | Constant:
    """Fit on at most `sample` labelled, not held-out documents of each label value."""
    known = (labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out("label_id"))
             .groupBy("label_id").agg(F.min("label").alias("label")))
    there = docs.select(F.col(id_col).alias("label_id")).join(known, "label_id")
    chosen = {}
    for value in (0, 1):
        rows = (there.filter(F.col("label") == value)
                .orderBy(F.xxhash64("label_id"), "label_id").limit(sample).collect())
        chosen.update({r["label_id"]: value for r in rows})
    values = set(chosen.values())
    if len(values) < 2:
        return Constant(float(values.pop()) if values else 1.0)
    rows = (docs.filter(F.col(id_col).isin(sorted(chosen)))
            .select(F.col(id_col).alias("i"), text_of(text_col).alias("t"))
            .collect())
    rows.sort(key=lambda r: (r["i"], r["t"]))
    codes = [padded(np.frombuffer(r["t"].encode(), np.uint8)) for r in rows]
    return Net().fit(*with_crops(codes, np.array([chosen[r["i"]] for r in rows], np.float32)))


def scorer(model: Net | Constant):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, score = batch.column(1), []
            for at in range(0, batch.num_rows, 256):
                codes = [padded(np.frombuffer(t.as_py().encode(), np.uint8))
                         for t in texts.slice(at, 256)]
                score.append(model.scores(codes))
            score = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:1], pa.array(score.astype(float)), *batch.columns[2:]],
                ["doc_id", "score", *batch.schema.names[2:]])
    return run


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    out = rows.mapInArrow(scorer(model), "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """The rows of `docs` that the classifier accepts, columns as they were. The row
    travels through the scoring task beside its text, so nothing is joined back."""
    model = train(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = f"doc_id long, score double, row {rows.schema['row'].dataType.simpleString()}"
    return rows.mapInArrow(scorer(model), schema).filter(F.col("score") >= ACCEPT).select("row.*")
