"""Language ID and the quality classifier: held-out accuracy, brute-force features, edges."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tillroll.llm import language_id, quality


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(truth)
    held = [i for i in truth if crc(i) % 3 == 1]
    assert all(got[i]["held_out"] == (crc(i) % 3 == 1) for i in truth)
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_ignores_labels_of_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").limit(300)
    held = language_id.held_out("doc_id")
    a = language_id.identify(docs).collect()
    b = language_id.identify(docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_language_edges(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (None, "the cat", "en"), (5, "la vie est", "fr"),
            (5, "la vie est", "fr"), (6, "sans langue", None), (7, "the dog and " * 200_000, "en"), (8, "ß", "de")]
    got = language_id.identify(spark.createDataFrame(rows, schema)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3))
    assert by[7]["lang_pred"] in ("en", "fr", "de") and by[None]["held_out"] is False
    none = language_id.identify(spark.createDataFrame([(1, "abc", None)], schema)).collect()
    assert none[0]["lang_pred"] == "und" and none[0]["score"] == 0
    assert language_id.identify(spark.createDataFrame([], schema)).collect() == []


def test_codewords_split_and_differ():
    for n in (2, 3, 4, 6, 7, 12, 30):
        code = language_id.codewords(n)
        assert len(code) == n and set(np.unique(code)) <= {-1, 1}
        assert (np.abs(code.sum(0)) < n).all()
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2)


def test_decoding_corrects_a_wrong_bit():
    code = language_id.codewords(5)
    bits = code.shape[1]
    d = language_id.Decoder(list("abcde"), code, np.eye(bits), np.zeros(bits), np.ones(bits))
    for i in range(5):
        margin = 4 * code[i].copy()
        margin[i] *= -0.5
        best, score, odd = d.predict(margin[None])
        assert best[0] == i and score[0] > 0.5 and not odd[0]
    assert d.predict(np.zeros((1, bits)))[2][0]  # no evidence: ambiguous


def test_language_features_match_plain_counts(monkeypatch):
    lut = language_id._letters()

    def plain(t):
        data, out = [int(x) for x in lut[np.frombuffer(t, np.uint8)]], Counter()
        for n in language_id.GRAMS:
            for i in range(len(data) - n + 1):
                code = n
                for x in data[i:i + n]:
                    code = (code * 0x01000193 & 0xFFFFFFFF) ^ x
                out[((code * 0x9E3779B1) & 0xFFFFFFFF) >> 20] += 1
        return out
    texts = [b"Abc dEf", b"", b"x", "é ß".encode(), b"one two three " * 40]
    for size in (1 << 20, 64):  # with and without slicing of long texts
        monkeypatch.setattr(language_id, "SLICE", size)
        x = language_id.features(texts[:4])
        for t, row in zip(texts, x):
            want = plain(t)
            total = max(1, sum(want.values()))
            assert {i: round(v * v * total) for i, v in enumerate(row) if v} == dict(want)


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").withColumn("label", F.lit(3))
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.score(docs, labels).collect()}
    assert len(got) == docs.count()
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [i for i in known if i in got and crc(i) % 4 == 2]
    s, y = np.array([got[i]["score"] for i in held]), np.array([known[i] for i in held])
    assert auc(s, y) > 0.9
    assert all(r["held_out"] == (crc(i) % 4 == 2) for i, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got.values())
    left = quality.accepted(docs, labels)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.select("doc_id").collect()) == sorted(
        i for i, r in got.items() if r["predicted"])


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "x", "b"), (3, "", "c"), (3, "", "c"), (4, "t " * 300_000, None)],
                                 "doc_id long, text string, score string")
    schema = "doc_id long, quality int, toxic int"
    for labels, want in (([], 1.0), ([(3, 0, 1), (1, None, 1)], 0.0), ([(4, 1, 0), (None, 0, 0)], 1.0)):
        learned = [i for i, q, _ in labels if i and q is not None and crc(i) % 4 != 2]
        got = quality.score(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(got) == 5 and {r["score"] for r in got} == {want if learned else 1.0}
    two = spark.createDataFrame([(i, i % 2, 0) for i in (1, 3, 4, 5)], schema)
    assert quality.score(docs, two).count() == 5
    assert quality.score(docs.filter("false"), two).collect() == []


def test_pooling_covers_whole_documents_and_slices(monkeypatch):
    net = quality.Net()
    rng = np.random.default_rng(0)
    docs = [quality.padded(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 15, 16, 17, 100, 5000)]
    want = [net.responses(np.array([d[i:i + quality.WIDTH] for i in range(0, len(d) - quality.WIDTH + 1, quality.STRIDE)])
                          ).max(0) for d in docs]
    assert np.allclose(net.pooled(docs), want, atol=1e-5)
    monkeypatch.setattr(quality, "SLICE", 64)
    assert np.allclose(net.pooled(docs), want, atol=1e-5)
    for n, d in zip((0, 1, 15, 16, 17, 100, 5000), docs):
        assert len(d) >= n and (len(d) - quality.WIDTH) % quality.STRIDE == 0


def test_quality_learns_from_the_end_of_long_texts(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(500):
        filler = "".join(map(chr, rng.integers(97, 123, 8300 + int(rng.integers(0, 300)))))
        rows.append((i, filler + ("<{GOOD}> " if i % 2 else "[#BAD#] ") * 20, i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    got = [r for r in quality.score(docs, labels).collect() if r["held_out"]]
    assert auc(np.array([r["score"] for r in got]), np.array([r["doc_id"] % 2 for r in got])) > 0.95


def test_winners_in_slices(monkeypatch):
    net, rng = quality.Net(), np.random.default_rng(1)
    docs = [quality.padded(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 16, 100, 5000)]
    whole = [net.winners(d) for d in docs]
    monkeypatch.setattr(quality, "SLICE", 64)
    for d, (top, best) in zip(docs, whole):
        assert np.allclose(top, net.pooled([d])[0], atol=1e-5)
        sliced, chunks = net.winners(d)
        assert np.allclose(top, sliced, atol=1e-5) and (best == chunks).all()
