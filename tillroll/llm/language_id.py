"""Language identification with error-correcting output codes.

Every language has a codeword of bits; one binary n-gram classifier per bit predicts it.
Up to six languages get the exhaustive code (all distinct two-way splits), more get the
best of several random dense codes of about 10 log2(L) bits. A text's bit margins are
decoded by weighted loss: the language with the smallest sum of weight * log(1 +
exp(-bit * margin)) wins, a bit's weight being its classifier's accuracy over chance. The
score is the winner's part of exp(-loss) over all languages; a text whose runner-up comes
within ``AMBIGUOUS`` of the score is flagged.

Features are hashed counts of byte 1- to 3-grams of the whole text (letters lowered, all
other ASCII read as space), as square roots of shares. The classifiers are fitted on the
driver on a bounded sample, at most ``SAMPLE`` rows in equal parts by language, none of
them held out; scoring is a scan without a shuffle, in slices of bounded size.

Defined cases: NULL text and texts without a letter are ``und`` with score 0; NULL langs
are not learned from; with one known language every text with a letter is that language,
with none ``und``; rows with a NULL id are never held out; an empty table gives no rows.
The language values themselves (a small vocabulary) come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_hash, text_of

DIM = 4096
GRAMS = (1, 2, 3)
SAMPLE = 2400
STEPS, RATE, DECAY = 150, 0.05, 1e-4
AMBIGUOUS = 0.2
DOCS, SLICE = 256, 1 << 20


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """n codewords of +-1 bits; every bit splits the languages."""
    if n <= 6:
        cols = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(cols, np.float32).T.reshape(n, -1)
    rng = np.random.default_rng(seed)
    bits, best, far = int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.float32), (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        same = code @ code.T - 2 * bits * np.eye(n)
        if (gap := float(code.shape[1] - same.max())) > far:
            best, far = code, gap
    return best


def _letters() -> np.ndarray:
    lut = np.full(256, 32, np.uint32)
    lut[128:] = np.arange(128, 256)
    lut[97:123] = lut[65:91] = np.arange(97, 123)
    return lut


def _grams(data: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Hashed gram counts; `doc` is each byte's text, grams do not span two texts."""
    out = np.zeros(n_docs * DIM, np.int64)
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, n, np.uint32)
        for i in range(n):
            code = code * np.uint32(0x01000193) ^ data[i:len(data) - n + 1 + i]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(20)
        own = doc[:len(code)] == doc[n - 1:]
        out += np.bincount(doc[:len(code)][own] * DIM + code[own], minlength=n_docs * DIM)
    return out.reshape(n_docs, DIM)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of gram shares (square roots) per text; long texts in slices."""
    lut = _letters()
    out = np.zeros((len(texts), DIM), np.float32)
    i = 0
    while i < len(texts):
        if len(texts[i]) > SLICE:
            data = np.frombuffer(texts[i], np.uint8)
            for at in range(0, len(data), SLICE):
                part = lut[data[max(0, at - max(GRAMS) + 1):at + SLICE]]
                out[i] += _grams(part, np.zeros(len(part), np.int64), 1)[0]
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) <= SLICE and j - i < DOCS:
            size += len(texts[j])
            j += 1
        data = lut[np.frombuffer(b"".join(texts[i:j]), np.uint8)]
        doc = np.repeat(np.arange(j - i), [len(t) for t in texts[i:j]])
        out[i:j] = _grams(data, doc, j - i)
        i = j
    return np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1))


class Decoder:
    """Bit classifiers and the code."""

    def __init__(self, langs: list[str], code: np.ndarray, w: np.ndarray, b: np.ndarray,
                 trust: np.ndarray):
        self.langs, self.code, self.w, self.b, self.trust = langs, code, w, b, trust

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, ambiguous) of each feature row."""
        if len(self.langs) == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        margin = x @ self.w + self.b
        loss = np.stack([(np.logaddexp(0, -margin * c) * self.trust).sum(1) for c in self.code], 1)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        two = np.sort(share, 1)[:, -2:]
        return share.argmax(1), two[:, 1], two[:, 1] - two[:, 0] < AMBIGUOUS


def fit(x: np.ndarray, langs: list[str], of: np.ndarray) -> Decoder:
    """All bit classifiers at once: logistic regression by Adam, languages weighed alike."""
    if len(langs) == 1:
        return Decoder(langs, np.zeros((1, 0)), np.zeros((DIM, 0)), np.zeros(0), np.zeros(0))
    code = codewords(len(langs))
    y = code[of]
    weight = (1 / np.bincount(of, minlength=len(langs)))[of].astype(np.float32)
    weight /= weight.sum()
    w, b = np.zeros((DIM, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for step in range(1, STEPS + 1):
        margin = x @ w + b
        g = -y / (1 + np.exp(np.clip(y * margin, -30, 30))) * weight[:, None]
        gw, gb = x.T @ g + DECAY * w, g.sum(0)
        for p, gr, m, v in ((w, gw, mw, vw), (b, gb, mb, vb)):
            m += 0.1 * (gr - m)
            v += 0.01 * (gr ** 2 - v)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    right = ((np.sign(x @ w + b) == y) * weight[:, None]).sum(0)
    return Decoder(langs, code, w, b, np.maximum(2 * right - 1, 0.01))


def held_out(id_col: str):
    """Documents whose language is never learned from."""
    return F.coalesce(F.pmod(doc_hash(F.col(id_col)), F.lit(3)) == 1, F.lit(False))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS):
            part = batch.slice(at, DOCS)
            x = features([t.as_py().encode() for t in part.column(1)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())],
                ["lang", "x"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", sample: int = SAMPLE) -> Decoder | None:
    known = (docs.filter(F.col(lang_col).isNotNull() & ~held_out(id_col))
             .select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("i")))
    langs = sorted(r[0] for r in known.select("lang").distinct().collect())
    if not langs:
        return None
    each = max(1, sample // len(langs))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("i"), "i")
    chosen = (known.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= each)
              .select("i").filter("i is not null").collect())
    rows = (docs.filter(F.col(id_col).isin(sorted({r["i"] for r in chosen})) & F.col(lang_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
            .mapInArrow(_vectors, "lang string, x binary").collect())
    rows.sort()
    if not rows:
        return None
    langs = sorted({r["lang"] for r in rows})
    x = np.frombuffer(b"".join(r["x"] for r in rows), "<f4").reshape(len(rows), DIM)
    return fit(x, langs, np.array([langs.index(r["lang"]) for r in rows]))


def predictor(model: Decoder | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                if model is None:
                    lang, score, odd = ["und"] * len(part), np.zeros(len(part)), np.zeros(len(part), bool)
                else:
                    best, score, odd = model.predict(features([t.as_py().encode() for t in part.column(1)]))
                    lang = [model.langs[i] for i in best]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(lang, pa.string()),
                     pa.array(np.asarray(score, float)), pa.array(np.asarray(odd, bool))],
                    ["doc_id", "lettered", "lang_pred", "score", "ambiguous"])
    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous."""
    model = train(docs, id_col, text_col, lang_col)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       text.rlike(r"\p{L}").alias("lettered"))
    out = rows.mapInArrow(
        predictor(model),
        "doc_id long, lettered boolean, lang_pred string, score double, ambiguous boolean")
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"),
        F.when(F.col("lettered"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"),
        (F.col("lettered") & F.col("ambiguous")).alias("ambiguous"))
