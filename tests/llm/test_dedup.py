"""Exact, near and line dedup against brute force, and their edge cases."""

import hashlib
import os
import random
import re
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from tillroll.llm import components as comp
from tillroll.llm import exact_dedup, line_dedup, linking, near_dedup
from tillroll.session import ensure_checkpoint_dir

SCHEMA = "doc_id long, text string, kept string, node long, n int"  # clashing extra columns
FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 7, 1) for i, t in rows], SCHEMA).repartition(parts)


def union(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        parent[find(a)] = find(b)
    low = {}
    for i in ids:
        low[find(i)] = min(low.get(find(i), i), i)
    return {i: low[find(i)] for i in ids}


def words(t, k):
    w = WORD.findall((t or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(
        tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["É", "ß", "İ"]
    rows, i = [], 0
    for _ in range(60):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 3])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "  \t"]).join(w)))
            i += 1
    rows += [(i, rows[3][1].upper()), (i + 1, ""), (i + 2, None), (i + 3, " \n "), (i + 4, "one"),
             (i + 5, "ONE"), (i + 6, "word " * 30_000)]
    return rows


def test_exact_matches_brute_force(spark):
    rows = corpus() + [(1000 + i, "Hot TEXT" if i % 2 else "hot text") for i in range(400)]
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(frame(spark, rows)).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(FOLD)].append(i)
    assert len(got) == len(rows)
    for t, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (max(ids), len(ids), i == max(ids))
            assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    left = exact_dedup.survivors(frame(spark, rows))
    assert left.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(max(v) for v in groups.values())


def test_exact_heavy_and_light_split(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HEAVY", 2)
    rows = [(i, f"t{i % 40}" if i % 3 else "hot") for i in range(600)]
    table = exact_dedup.digest_table(frame(spark, rows))
    heavy, rest = exact_dedup.split_heavy(table)
    assert heavy.count() <= 2 and rest.count() < 600
    got = exact_dedup.exact_dedup(frame(spark, rows))
    assert got.filter("kept").count() == len({t for _, t in rows})
    assert got.count() == 600


def test_exact_repeated_rows_null_ids_empty(spark):
    rows = [(None, "a"), (None, "A"), (5, "a"), (5, "a"), (None, "z")]
    got = sorted(map(tuple, exact_dedup.exact_dedup(frame(spark, rows)).select(
        "doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got.count((5, 5, 4, True)) == 1 and got.count((5, 5, 4, False)) == 1
    assert got.count((None, 5, 4, False)) == 2 and (None, None, 1, True) in got
    assert exact_dedup.survivors(frame(spark, rows)).count() == 2
    empty = frame(spark, rows).filter("false")
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert exact_dedup.survivors(empty).collect() == []


def test_components(spark):
    rng = random.Random(3)
    ids = list(range(300))
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(180)]
    pairs += [(299, i) for i in range(100, 140)] + [(i, i + 1) for i in range(200, 230)]
    links = spark.createDataFrame(pairs, "u long, v long")
    got = {r["node"]: r["component"] for r in comp.components(links).collect()}
    want = union(ids, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert comp.components(links.filter("false")).collect() == []


def test_near_matches_brute_force(spark):
    rows, k = corpus(2), 2
    sets = {i: words(t, k) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union(ids, pairs)
    out = near_dedup.near_components(frame(spark, rows), k=k)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in ids}
    left = near_dedup.survivors(frame(spark, rows), k=k)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i in ids if want[i] == i)


def test_near_chain_through_hot_group(spark):
    """A group too wide for its pivot: links found only between other members."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for step in range(40):
        base = base[2:] + [f"n{step}a", f"n{step}b"]
        rows.append((step, " ".join(base)))
    sets = {i: words(t, 2) for i, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert (0, 1) in pairs and (0, 39) not in pairs
    want = union(sets, pairs)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_components(frame(spark, rows), k=2).collect()}
    assert got == want


def test_near_threshold_family(spark, monkeypatch):
    """600 documents around one text, similarities just below 0.8: as brute force, without
    all of the 179,700 pairs."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        w = list(base)
        for _ in range(rng.randint(9, 12)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    sets = {i: words(t, 2) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union(sets, links)
    met = []
    wrapped = linking.written

    def counting(df, name):
        out = wrapped(df, name)
        if name in ("pairs", "families"):
            met.append((name, out.count()))
        return out
    monkeypatch.setattr(linking, "written", counting)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_components(frame(spark, rows), k=2).collect()}
    assert got == want and len(set(want.values())) > 100
    assert sum(n for name, n in met if name == "pairs") < 120_000, met


def test_near_edges(spark):
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "q r s"), (9, None), (8, "")]
    got = sorted(map(tuple, near_dedup.near_components(frame(spark, rows), k=2).collect()), key=str)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 2, None, True),
                          (9, 0, 9, True), (8, 0, 8, True)], key=str)
    assert near_dedup.near_components(frame(spark, rows).filter("false")).collect() == []


def byte_sets(line):
    b = line.strip(" ").lower().encode()
    return frozenset(b[i:i + 8] for i in range(max(1, len(b) - 7)))


def test_lines_match_brute_force(spark):
    rng = random.Random(5)
    pool = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randint(0, 99))
                     for _ in range(rng.randint(1, 14))) for _ in range(60)]
    rows = []
    for i in range(80):
        ls = []
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(pool)
            if rng.random() < 0.4:
                at = rng.randrange(len(line))
                line = line[:at] + "x" + line[at + 1:]
            ls.append(line)
        rows.append((i, "\n".join(ls + ["Common LINE of all"])))
    rows += [(100, None), (101, "\n\n"), (102, "é" * 9 + "\r\nshort")]
    lines = [(i, n, x) for i, t in rows for n, x in enumerate(re.split("\r?\n", t or ""))]
    filled = [(i, n, x) for i, n, x in lines if x.strip(" ")]
    sets = {(i, n): byte_sets(x) for i, n, x in filled}
    pairs = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union(sets, pairs)
    want |= {(i, n): (i, n) for i, n, x in lines if (i, n) not in sets}
    got = {(r["doc_id"], r["line_no"]): ((r["keep_doc_id"], r["keep_line_no"]), r["kept"])
           for r in line_dedup.line_components(frame(spark, rows)).collect()}
    assert got == {k: (v, v == k) for k, v in want.items()}
    texts = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(frame(spark, rows)).collect()}
    assert len(texts) == len(rows)
    for i, _ in rows:
        assert texts[i].split("\n") == [x for d, n, x in lines if d == i and want[d, n] == (d, n)] or texts[i] == ""


def test_containment_pairs_share_bands(spark):
    """Lines with text cut off, at exactly 0.8: 16 to 400 of 20 to 500 shingles."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    pairs = []
    for n in (20, 45, 50, 55, 100, 500):
        for _ in range(700):
            whole = text(n + 7)
            pairs.append((whole, whole[:n * 4 // 5 + 7]))
    assert all(100 * len(byte_sets(b)) >= 80 * len(byte_sets(a)) for a, b in pairs)
    df = spark.createDataFrame(pairs, "a string, b string").repartition(4)
    keys = [line_dedup.signature(F.col(c).cast("binary"))["keys"] for c in "ab"]
    missed = df.filter(~F.arrays_overlap(*keys)).groupBy(F.length("a")).count().collect()
    assert sum(r["count"] for r in missed) <= 2, missed


def test_containment_lines_match_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for i in range(150):
        line = "".join(rng.choice("abcdefghij ") for _ in range(rng.choice([40, 57, 132, 307]))).strip() + "z"
        rows += [(2 * i, line), (2 * i + 1, line[:7 - (-(len(line) - 7) * 81 // 100)])]
    sets = {i: byte_sets(t) for i, t in rows}
    want = union(sets, [(a, b) for a in sets for b in sets if a < b
                        and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    got = {r["doc_id"]: r["keep_doc_id"] for r in line_dedup.line_components(frame(spark, rows)).collect()}
    assert got == want and sum(i != j for i, j in want.items()) >= 100


def test_lines_edges(spark):
    rows = [(None, "same line here"), (3, "same line here"), (3, "Same line here ")]
    got = [tuple(r) for r in line_dedup.line_components(frame(spark, rows)).collect()]
    assert sum(r[-1] for r in got) == 1 and all(r[2] == 3 for r in got) and len(got) == 3
    assert line_dedup.line_components(frame(spark, rows).filter("false")).collect() == []


def test_hot_line_is_one_node(spark):
    rows = [(i, "the same line everywhere\nand own line number %d of this text" % (i * 7919)) for i in range(300)]
    out = line_dedup.line_components(frame(spark, rows, 8)).filter(F.col("line_no") == 0)
    assert out.filter("kept").count() == 1 and out.filter("keep_doc_id = 0").count() == 300


def test_shared_parts_leave_out_what_no_other_node_has(spark):
    rows = [(1, 9, [1, 2], [3, 4]), (2, 9, [1, 5], [6, 4]), (3, 9, [2, 1], [7, 8]), (4, 9, [1, 9], [10, 11])]
    nodes = spark.createDataFrame(rows, "node long, n long, a array<long>, b array<long>")
    got = {r["node"]: r for r in linking.shared_parts(nodes).collect()}
    # 3 has 1 at another place; 4 shares no key of the second collection
    assert set(got) == {1, 2} and all(len(r["a"]) == len(r["b"]) == 1 for r in got.values())
    assert got[1]["a"] == got[2]["a"] and got[1]["b"] == got[2]["b"]


def _tables(spark):
    at = Path(urlparse(ensure_checkpoint_dir(spark)).path) / "tables"
    return {p.name for p in at.iterdir()} if at.exists() else set()


def test_linking_gives_up_its_scratch_tables(spark):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [base, base + " x", base + " y", "z " + base, "quite another text of few words", base + " x"]
    before = _tables(spark)
    left = near_dedup.survivors(frame(spark, list(enumerate(texts)))).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in left) == [0, 4]
    assert {t.rsplit("-", 1)[0] for t in _tables(spark) - before} == {"gone-ids"}
    before = _tables(spark)
    out = line_dedup.line_components(frame(spark, list(enumerate(texts))))
    assert {t.rsplit("-", 1)[0] for t in _tables(spark) - before} == {
        "line-signatures", "line-members", "first-lines"}
    assert out.filter("kept").count() == 2


def test_lines_travel_as_texts_and_signatures_go(spark, monkeypatch):
    """Line sets, eight times their texts, are not written; the signatures go once read."""
    made = {}
    for module in (linking, line_dedup):
        def note(df, name, *more, wrapped=module.written):
            out = wrapped(df, name, *more)
            made.setdefault(name, out)
            return out
        monkeypatch.setattr(module, "written", note)
    line = "the quick brown fox jumps over the lazy dog and runs away from all of it "
    # around a pivot some lines are similar to it, others only to each other
    texts = [line + line[:i] for i in range(0, 60, 4)] + ["another line that is like no other here"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = line_dedup.line_components(docs)

    def shingles(t):
        b = t.strip().encode()
        return {b[i:i + 8] for i in range(len(b) - 7)}

    root = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            x, y = shingles(a), shingles(b)
            if len(x & y) * 100 >= 80 * len(x | y):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert {r.doc_id: r.keep_doc_id for r in got.collect()} == dict(enumerate(root))
    assert dict(made["sets"].dtypes)["set"] == "binary"
    folder = made["line-keys"].inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert not os.path.exists(folder)
