"""Mixing against a plain computation; packing as an exact round trip."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import mixing, packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "c") for i, t, s in rows],
                                 "doc_id long, text string, source string, size int, target string")


def targets_of(tokens):
    """Reshare in rounds until no source is above three times its size."""
    order = sorted((s for s in tokens if s is not None)) + ([None] if None in tokens else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(tokens.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * tokens[s]]
        if not over:
            return {**share, **fixed}
        fixed |= {s: 3 * tokens[s] for s in over}


def mix_rows(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        s = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "ü", "z", None, "tiny"] if i % 50 else ["tiny"])
        if s == "tiny" and rng.random() < 0.9:
            s = "a"
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), s))
    return rows + [(900, None, "b"), (901, "x " * 40_000, "c"), (902, "", "empty"), (902, "", "empty")]


def test_mix(spark):
    rows = mix_rows()
    got = mixing.mix(docs_of(spark, rows)).collect()
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    tokens = defaultdict(int)
    for i, _, s in rows:
        tokens[s] += size[i]
    want, source = targets_of(dict(tokens)), {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == tokens[s]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["copies"] * r["size"] + r["part"]
        taken[s] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1
    again = mixing.mix(docs_of(spark, rows).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_whole_copies_and_empty(spark):
    rows = mix_rows(4)
    out = mixing.mixed_documents(docs_of(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "size", "target"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs_of(spark, rows), partial=False).collect()}
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert {k: v for k, v in copies.items() if v and k != 902} == {k: v for k, v in got.items() if k != 902}
    empty = docs_of(spark, rows).filter("false")
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_solver_with_two_constraint_columns(spark):
    """Newton on overlapping constraints reaches both sets of targets."""
    cells = spark.createDataFrame([("a", "x", 100), ("a", "y", 50), ("b", "x", 30), ("b", "y", 200)],
                                  "grp string, lang string, tokens long")
    by_grp = spark.createDataFrame([("a", 200.0), ("b", 180.0)], "grp string, target double")
    by_lang = spark.createDataFrame([("x", 190.0), ("y", 190.0)], "lang string, target double")
    out = mixing.solve_rates(cells, {"grp": by_grp, "lang": by_lang}, cap=50, tolerance=1e-9).collect()
    for col, want in (("grp", {"a": 200, "b": 180}), ("lang", {"x": 190, "y": 190})):
        got = defaultdict(float)
        for r in out:
            got[r[col]] += r["tokens"] * r["rate"]
        for k, v in want.items():
            assert math.isclose(got[k], v, rel_tol=1e-6)
    odds = {(r["grp"], r["lang"]): r["rate"] for r in out}  # exponential tilt: a product form
    assert math.isclose(odds["a", "x"] * odds["b", "y"], odds["a", "y"] * odds["b", "x"], rel_tol=1e-6)


TEXTS = [None, "", "a", "Hello, world!  Two  spaces\n\n\nlines\t tabs ", "ünïcödé — ß 日本語 テスト " * 30,
         "x" * 5000, " lead and trail ", "<|endoftext|> is a string here", "nbsp here\x85\x1c sep",
         "don't we'll 123 4567 ### $$$ \r\n end", "many words in a long text. " * 3000, "é" * 1024, "\n", "   "]


@pytest.fixture(scope="module")
def packed(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "no id")]
    rows += [(100 + i, " ".join(f"tok{i * j % 97}" for j in range(i * 13 % 400))) for i in range(300)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                               "doc_id long, text string, offset int, sequence_id int")
    return rows, packing.pack(df, group=64).collect()


def test_pieces_hold_every_id_once(packed):
    rows, got = packed
    tok = Tokenizer.from_file(packing.default_paths()[0])
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    copies = defaultdict(int)
    for i, _ in rows:
        copies[i] += 1
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == len(ids) * copies[i]
        assert sum(r["length"] for r in {r["start"]: r for r in pieces}.values()) == len(ids)
        for r in pieces:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(ids)


def test_sequences_are_gapless_and_full(packed):
    _, got = packed
    seq = defaultdict(list)
    for r in got:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in seq.values():
        at = 0
        for off, n in sorted(pieces):
            assert off == at and n > 0
            at += n
        assert at <= packing.WINDOW
    tokens = sum(r["length"] for r in got)
    assert len(seq) * packing.WINDOW <= tokens * 1.1 + packing.WINDOW * 8


def test_differencing_beats_capacity_and_stays_near_equal():
    rng = random.Random(1)
    sizes = sorted((rng.randint(1, 256) for _ in range(700)), reverse=True)
    dealt = packing.windows(sizes, 1024)
    sums = [sum(sizes[i] for i in w) for w in dealt]
    assert sorted(i for w in dealt for i in w) == list(range(700))
    assert max(sums) <= 1024 and sum(sums) / (1024 * len(sums)) > 0.97
    assert max(sums) - min(sums) < 100
    assert packing.windows([1024, 1024, 1], 1024) and len(packing.windows([700, 700, 700], 1024)) == 3
    assert packing.difference([], 3) == []


def test_pack_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df).collect() == []


def test_slices_of_long_texts_agree(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 50)
    enc, tok = packing.Encoder(*packing.default_paths()), Tokenizer.from_file(packing.default_paths()[0])
    for t in TEXTS:
        if t:
            got = np.frombuffer(b"".join(enc.blocks(t)), "<u4").tolist()
            assert got == tok.encode(t, add_special_tokens=False).ids


def test_frequent_chunks_stay_known_beyond_the_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 4)
    asked = []
    chunks = packing.Chunks(lambda chunk: asked.append(chunk) or [len(chunk)])
    for i in range(50):
        assert chunks["often"] == b"\5\0\0\0"
        assert chunks[f"rare {i}"] == bytes([len(f"rare {i}"), 0, 0, 0])
        assert len(chunks) + len(chunks.aside) <= 8
    assert asked.count("often") == 1 and len(asked) == 51


def test_a_worker_keeps_its_encoder():
    paths = packing.default_paths()
    assert packing.kept_encoder(*paths) is packing.kept_encoder(*paths)
