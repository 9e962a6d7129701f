"""Spelling variants, bit-plane clustering and token files against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from tillroll.llm import clustering, spelling, token_files, wavelet
from tillroll.llm.queries import QUERIES

DOCS = "doc_id long, text string, word string, id long, n int"  # clashing extra columns
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def docs_frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 7, 1) for i, t in rows], DOCS).repartition(parts)


# --- spelling variants -------------------------------------------------------------

def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    out, form = {}, {}
    for w in n:
        close = [x for d in (-1, 0, 1) for x in by_length.get(len(w) + d, []) if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = len(close)
    result = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        result.append((w, form[w], root, n[w], out[w], n[form[w]] if form[w] else None))
    return sorted(result)


def got_variants(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n"))
                  for r in df.collect())


def test_variants_on_words_made_to_be_near(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abà") for _ in range(rng.randint(4, 9))) for _ in range(30)]
    stems += ["aaaaa", "aaaaaa", "aaaaaaa", "baaaaa", "ababab", "ÀÉéßÿ", "naïve", "x" * 47, "x" * 48,
              "x" * 49, "x" * 46 + "y", "x" * 47 + "y", "y" + "x" * 47, "x" * 48 + "y", "x" * 49 + "y",
              "ab" * 3000, "ab" * 2999 + "a", "ab" * 2999 + "ac"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(stems)
            if rng.random() < 0.3:
                p = rng.randrange(len(w))
                w = w[:p] + rng.choice(["", "a", "b", "ç"]) + w[p + rng.choice([0, 1]):]
            words.append(rng.choice([w, w.upper() if w.isascii() else w]))
        rows.append((i, rng.choice([" ", "-", "\n", "1"]).join(words)))
    rows += [(400, None), (401, ""), (None, "spelling spelling spelling"), (7, rows[7][1]), (402, "ab cd")]
    want = plain_variants(rows)
    assert got_variants(spelling.variants(docs_frame(spark, rows))) == want
    assert len(want) > 100 and any(r[1] for r in want) and any(r[1] != r[2] for r in want if r[1])


def test_variants_of_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got_variants(QUERIES["op11_spelling_variants"](spark, SF_SMALL)) == plain_variants(rows)


def test_rotation_keys_do_not_depend_on_the_side_of_the_text_limit():
    for length in (45, 46, 47, 48, 49, 50, 80):
        long, short = "b" + "a" * length, "a" * length
        skips = {k for k, skipped, _ in spelling.rotations(long, 12345) if skipped}
        assert skips & {k for k, skipped, _ in spelling.rotations(short, 12345) if not skipped}


def test_variants_of_an_empty_table(spark):
    assert spelling.variants(docs_frame(spark, [], 1)).count() == 0
    assert spelling.variants(docs_frame(spark, [(1, "no word thrice")], 1)).count() == 0


# --- clustering --------------------------------------------------------------------

def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64
            and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, j, d in found:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(map(str, ((i, j, d, per[j], sum(per.values()), digest[j]) for i, j, d in found)))


def got_clusters(df):
    return sorted(str(tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia",
                                           "inertia", "centroid_sha256"))) for r in df.collect())


VECS = "vec_id long, embedding array<double>, cluster string, planes int"


def vec_frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECS).repartition(parts)


def test_clusters_of_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, s) for _ in range(64)]) for i, s in enumerate([0.2, 1, 5, 900] * 40)]
    rows += [(200 + i, list(rows[3][1])) for i in range(30)]  # repeated vectors, ties
    rows += [(5, [0.0] * 64), (5, [1.0] * 64), (None, [-2.0] * 64), (300, None), (301, [1.0] * 63),
             (302, [None] + [0.0] * 63), (303, [float("nan")] + [0.0] * 63), (304, [float("inf")] * 64),
             (305, []), (306, [-1.0] * 64), (307, [127 / 64] * 64), (308, [-128 / 64] * 64)]
    assert got_clusters(clustering.clustered(vec_frame(spark, rows))) == plain_clusters(rows)


def test_few_vectors_and_none(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert got_clusters(clustering.clustered(vec_frame(spark, rows, 1))) == plain_clusters(rows)
    assert clustering.clustered(vec_frame(spark, [], 1)).count() == 0
    assert clustering.clustered(vec_frame(spark, [(1, None)], 1)).count() == 0


def test_one_vector_that_fills_most_of_the_table(spark):
    rng = random.Random(8)
    rows = [(i, [0.5] * 64) for i in range(500)] + [
        (500 + i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(100)]
    assert got_clusters(clustering.clustered(vec_frame(spark, rows, 7))) == plain_clusters(rows)


def test_clusters_of_the_table(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    assert got_clusters(QUERIES["op12_clustering"](spark, SF_SMALL)) == plain_clusters(rows)


def test_popcounts_give_exact_products():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-clustering.LIMIT, clustering.LIMIT + 1, (50, 64)), rng.integers(-100, 3, (7, 64))
    px, pc = clustering.pack(x, int(clustering.needed(x).max())), clustering.pack(c, 9)
    assert (clustering.products(px, pc) == x @ c.T).all()
    assert (clustering.norms(px) == (x * x).sum(1)).all()
    member = rng.integers(0, 4, 50)
    assert (clustering.column_sums(px, member, 5)
            == np.stack([x[member == j].sum(0) for j in range(5)])).all()
    assert clustering.needed(np.array([[0], [1], [-1], [-2], [127], [-128], [128]])).tolist() == [
        1, 2, 1, 2, 8, 8, 9]


# --- token files -------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 5, wavelet.BLOCK - 1, wavelet.BLOCK, wavelet.BLOCK + 1, 3 * wavelet.BLOCK])
def test_wavelet_answers(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 49_407).astype(np.uint32)
    r = wavelet.Reader(wavelet.build(ids, 16, [3, None], [n, 0]))
    assert (r.tokens(0, n) == ids).all() and (r.everything() == ids).all() and r.documents()[0] == [3, None]
    assert r.documents()[1].tolist() == [n, 0]
    places = rng.integers(0, n, 20) if n else np.zeros(0, np.int64)
    assert (r.access(places) == ids[places]).all()
    for t in {1, 2, 700, 49_407, 70_000, *ids[:3].tolist()}:
        want = np.flatnonzero(ids == t)
        assert r.count(t) == len(want) and (r.occurrences(t) == want).all()
        a, b = n // 3, n // 2
        inside = want[(want >= a) & (want < b)]
        assert r.count(t, a, b) == len(inside) and (r.occurrences(t, a, b) == inside).all()
        for k in {0, len(want) // 2, len(want) - 1} if len(want) else ():
            assert r.select(t, k) == want[k]
        with pytest.raises(IndexError):
            r.select(t, len(want))
    with pytest.raises(IndexError):
        r.access([n])


def plain_tokens(rows):
    library = Tokenizer.from_file(token_files.default_path())
    return [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]


ODD = ["", None, " ", "One two.", "İstanbul ΣΑΣ Σ", "áb é", "x y z", "q\x1cw\x85e",
       "don't WE'LL <|startoftext|> it's<|endoftext|>s", "日本語テキスト  と", "a\x0bb\x0cc\rd", "😀😀 ½ ²3 ١٢",
       "naïve Ça ÀÉÎ ß'S ª º µm a×b 1½ ___ a_b 12'34 x'rex 'd <|x|> ''s \"'s", "a\xadb\x7f\x01",
       "́ ́x", "﻿a​b", "word " * 300_000, "y" * 5000, "한글 한"]


def test_files_hold_the_librarys_ids_in_order(spark, tmp_path):
    rows = [(100 - 3 * i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (52, "again"), (52, "again twice")]
    df = docs_frame(spark, rows, 1)
    path = str(tmp_path / "files")
    token_files.write_tokens(df, path, shard=50)
    want = plain_tokens(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))
    got = sorted(token_files.document_index(spark, path).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["n_tokens"]) for r in got if r["doc_id"] != 52] == [
        (i, len(x)) for i, x in want if i != 52]
    place = 0
    for r in got:
        assert r["start"] == place
        place += r["n_tokens"]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in got) == sorted((str(i), crc(x)) for i, x in want)
    # lookups in the files
    order = {(r["doc_id"], r["ids_crc32"]): r["start"] for r in got}
    flat = [None] * place
    for i, x in want:
        flat[order[i, crc(x)]:order[i, crc(x)] + len(x)] = x
    asked = [2, flat[0], flat[place // 2], 49_000]
    assert {r["token"]: r["n"] for r in token_files.token_counts(spark, path, asked).collect()} == {
        t: flat.count(t) for t in asked}
    there = token_files.token_places(spark, path, flat[5]).collect()
    assert sorted(r["place"] for r in there) == [j for j, t in enumerate(flat) if t == flat[5]]
    start_of = {}
    for r in got:
        start_of.setdefault(r["doc_id"], set()).add(r["start"])
    assert all(r["place"] - r["offset"] in start_of[r["doc_id"]] for r in there)
    part = token_files.tokens_at(spark, path, 3, 90).collect()
    assert [r["token"] for r in sorted(part)] == flat[3:90]
    # one file per shard, and nothing left of an earlier write
    token_files.write_tokens(df.filter("doc_id = 100"), path)
    assert token_files.document_index(spark, path).count() == 1


def test_files_of_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want, place = [], 0
    for i, ids in plain_tokens(sorted(rows)):
        want.append((i, place, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        place += len(ids)
    got = QUERIES["op13_token_files"](spark, SF_SMALL)
    assert sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in got.collect()) == want


def test_files_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(docs_frame(spark, [], 1), path)
    assert token_files.document_index(spark, path).count() == 0
    assert token_files.token_counts(spark, path, [5]).collect()[0]["n"] == 0
    assert token_files.tokens_at(spark, path, 0, 5).count() == 0


def test_one_document_id_on_most_rows(spark):
    rows = [(1, f"copy {i % 3} of a text") for i in range(300)] + [(i, "other") for i in range(50)]
    got = token_files.encoded(docs_frame(spark, rows, 5), shard=100).collect()
    assert len(got) == 350 and sum(r["n_tokens"] for r in got) == sum(len(x) for _, x in plain_tokens(rows))
    starts = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in got)
    assert [s for s, _, _ in starts] == [sum(n for _, n, _ in starts[:j]) for j in range(350)]
    assert [i for _, _, i in starts] == sorted(i for i, _ in rows)


def test_words_of_the_plain_alphabet_are_the_librarys():
    rng = random.Random(4)
    letters = [chr(c) for c in [*range(33, 127), *range(192, 256)] if c not in (215, 247)]
    encoder = token_files.Encoder(token_files.default_path(), "<u4")
    texts = [" ".join("".join(rng.choices(letters + list("'sdtelrv") * 6, k=rng.randint(1, 12)))
                      for _ in range(40)) for _ in range(500)]
    for text in texts:
        want = encoder.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want
