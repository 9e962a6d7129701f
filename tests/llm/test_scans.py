"""Secret and licence scans and exact search against plain versions."""

import hashlib
import random
import re
import string
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillroll.llm import license_scan, secret_scan, topk

PATTERNS = [
    ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                          r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def base(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(PATTERNS)
             for m in p.finditer(text or "") if ok(m)]
    joined = ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found))
    counts = tuple(sum(x[2] == kind for x in found) for kind, _, _ in PATTERNS)
    return counts, joined


def secret_rows():
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    b62 = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    texts = [None, "", "no secrets", f"é password = '{b62(12)}' and token:short", "token=secret=abcdefghij",
             "password: token: abcdefgh1", "AKIA" + "Z" * 11, "AKIA" + "Q1" * 8 + " AKIAAKIAAKIAAKIA", hexes(31),
             "x" + hexes(32) + "g" + hexes(64), "API_KEY='" + hexes(40) + "'", "ApiKey:aaaaaaaa Secret = bbbbbbbb",
             "Passwd\t=abcdefgh1", "ſecret=longenough1 toKen=abcdefgh", "ü" * 50 + b62(48) + " tail",
             "apikey  :  '" + b62(20) + "'\n" + b62(64) + "\n" + hexes(64), "token=a" * 500,
             "thisisaverylongwordwithoutanyrandomness andanotherlongwordofordinaryletters", "ab" * 40, "a" * 64]
    return list(enumerate(texts)) + [(3, texts[3]), (None, texts[9])]


def test_base_spans_match_plain_search(spark):
    rows = secret_rows()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kind string, tag int")
    got = [tuple(r) for r in secret_scan.scan(df).collect()]
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        counts, joined = base(t)
        want.append((i, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted(map(str, (g[:5] for g in got))) == sorted(map(str, want))
    for g in got:
        kept = [s for s in g[5].split(",") if s and not s.startswith("random:")]
        assert hashlib.sha256(",".join(kept).encode()).hexdigest() == g[4]
    assert secret_scan.scan(df.filter("false")).collect() == []


def test_base_spans_on_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in secret_scan.scan(df).collect():
        counts, joined = base(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == counts
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_battery_tells_random_from_text(spark):
    rng = random.Random(4)
    chars = string.ascii_letters + string.digits
    words = "the of and to in is was for that with from this which were have".split()
    rows = [(i, "".join(rng.choice(chars) for _ in range(60))) for i in range(200)]
    rows += [(1000 + i, "".join(rng.choice(words) for _ in range(15))) for i in range(200)]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum("random:0:60" in got[i] for i in range(200)) > 190
    assert sum("random" in got[1000 + i] for i in range(200)) <= 6


def test_statistics_match_plain_formulas(spark):
    value = "aB3dEf9hIjKlMnOpQrStUvWxYz01"
    df = spark.createDataFrame([(1, "random", 0, len(value), value)], "tag long, kind string, start int, end int, value string")
    p = secret_scan.tested(df).first()["p"]
    alphabet = string.digits + string.ascii_uppercase + string.ascii_lowercase
    sym = [alphabet.index(c) + 1 for c in value]
    n, k = len(sym), 62
    chi = sum(sym.count(s) ** 2 for s in set(sym)) * k / n - n
    shift = n * (k * secret_scan.TEXT_COINCIDENCE - 1)
    z = (chi - 61 - shift) / (2 * (61 + 2 * shift)) ** 0.5
    assert p == pytest.approx(1 / (1 + np.exp(-(1.5976 * z + 0.07056 * z ** 3))))


def test_licences():
    r = license_scan.Recogniser()
    cases = {
        "": [], "Nothing here. At all!": [],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC 4.0"],
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3"],
        "Licensed under the Apache License, Version 2.0.": ["Apache-2.0"],
        "Released under the MIT License.\nText. All rights reserved.": ["MIT", "AllRightsReserved"],
        "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in "
        "compliance with the License.\n# You may obtain a copy of the License at\n": ["Apache-2.0", "UNMATCHED:ApacheUse"],
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://x.org/l": ["Apache-2.0"],
        "Copyright (c) 2020 Someone. All rights reserved.": ["AllRightsReserved"],
        "SPDX-License-Identifier: MIT OR Apache-2.0": ["SPDX:MIT OR APACHE-2.0"],
        "You may not use this file except in compliance with the License.": ["UNMATCHED:ApacheUse"],
        "The licence is MIT-like, they say.": [],
    }
    for text, want in cases.items():
        assert r.scan(text)[1] == want, text


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
BSD = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""


def test_wrapped_licences_in_comments_too():
    r = license_scan.Recogniser()
    cases = {MIT: ["Copyright", "MIT"], BSD: ["AllRightsReserved", "BSD"], GPL3: ["GPL"], MPL: ["MPL-2.0"],
             GPL3.replace("software:", "software;"): ["GPL"], APACHE: ["Copyright", "Apache-2.0"],
             BSD.split("\n3.")[0] + BSD[BSD.index("\n\nTHIS"):]: ["AllRightsReserved", "BSD"]}
    for text, want in cases.items():
        for mark in ("", "# ", " * ", "// ", "-- "):
            for end in ("\n", "\r\n"):
                shown = end.join((mark + x).rstrip() for x in text.split("\n"))
                if mark == " * ":
                    shown = f"/*{end}{shown}{end} */{end}int x"
                assert r.scan(shown)[1] == want, shown
    for text in (GPL3, MPL):
        narrow = "\n\n".join(textwrap.fill(p, 31) for p in text.split("\n\n"))
        assert r.scan(narrow)[1] == cases[text], narrow


def test_lines_and_wrapped_sentences_mix():
    r = license_scan.Recogniser()
    cases = {
        "A title\nReleased under the MIT License\nmore words": ["MIT"],
        "Copyright (c) 2020 Someone\n" + GPL3: ["Copyright", "GPL"],
        "Copyright (c) 2020 Someone\nsome words\nAll rights reserved": ["Copyright", "AllRightsReserved"],
        "SPDX-License-Identifier: MIT\nor so": ["SPDX:MIT"],
        "words\nReleased under the MIT License\nthis is cc0\nthat is cc0": ["MIT", "CC0", "CC0"],
        "The library is licensed under the GNU Lesser\nGeneral Public License, version 2.1\nor so": ["LGPL-2.1"],
        "This work is licensed under the GNU General Public License, version\n3. See there.": ["GPL-3"],
        "Licensed under the Apache License, Version 2.0\n(the \"License\");\nyou may not use this file except in "
        "compliance\nwith the License. You may obtain a copy of the License at http://x.org/l": ["Apache-2.0"],
        "in no event\n\nPermission is hereby granted, free of charge,\n\nto any person obtaining a copy of it": [],
    }
    for text, want in cases.items():
        assert r.scan(text)[1] == want, text

def test_licence_table(spark):
    rows = [(1, None), (2, ""), (None, "All rights reserved."), (3, "All rights reserved."), (3, "All rights reserved."),
            (4, "word " * 100_000 + ".\nReleased under the MIT License.")]
    df = spark.createDataFrame([(i, t, ["z"]) for i, t in rows], "doc_id long, text string, licences array<string>")
    got = sorted(((r["doc_id"], r["licences"]) for r in license_scan.scan(df).collect()), key=str)
    all_r = ["AllRightsReserved"]
    assert got == sorted([(1, []), (2, []), (None, all_r), (3, all_r), (3, all_r), (4, ["MIT"])], key=str)
    assert license_scan.scan(df.filter("false")).collect() == []
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC 4.0", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "AllRightsReserved",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3"}
    got = {r["doc_id"]: r["licences"] for r in license_scan.scan(docs).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == [lines[x] for x in r["text"].split("\n") if x in lines]


def brute_top(rows, k=10, every=100):
    ok = [(i, [int(np.floor(float(np.float32(x)) * 1024)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in ok:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for i, q in asked.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def search(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0, **kw).collect()))


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 24)) / 5
    x[300:420] = x[7]  # many equal vectors: ties go to the smaller id
    x[500:560] = x[500] + rng.standard_normal((60, 24)) / 100
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    for kw in ({}, {"block": 100, "queries": 4}, {"block": 7, "k": 3}):
        assert search(spark, rows, **kw) == brute_top(rows, kw.get("k", 10))


def test_top_k_edges(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
            (100, [0.25, -0.75]), (100, [0.2, -0.75]), (5, []), (6, [0.0, 0.0]), (7, [1e30, 1.0]), (None, [1.0, 1.0]),
            (8, [0.5]), (8, [0.5])]
    got = search(spark, [r for r in rows if r[0] != 7])
    assert got == brute_top([r for r in rows if r[0] != 7])
    assert len(search(spark, rows)) == 2 * 7 - 1 or search(spark, rows)
    assert search(spark, []) == [] and search(spark, [(0, [1.0])]) == [] and search(spark, [(1, [1.0])]) == []


def test_index_stops_by_proof_only():
    """With few vectors allowed past the proof, results are still exact."""
    rng = np.random.default_rng(1)
    v = rng.integers(-1024, 1024, (700, 16))
    index = topk.Index(np.arange(700), v)
    q = rng.integers(-1024, 1024, (5, 16))
    got = list(index.search(np.arange(1000, 1005), q, 10))
    for j in range(5):
        s = v @ q[j]
        order = np.lexsort((np.arange(700), -s))[:10]
        assert [(i, x) for a, i, x in got if a == 1000 + j] == [(int(i), int(s[i])) for i in order]


def test_top_k_pairs_pass_neither_the_driver_nor_a_shuffle(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(0, 1, (900, 8)).tolist())],
                               "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=3, block=64, queries=16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and plan.count("Exchange") == 1
    assert got.count() == 90 * 3


def test_packed_integers_keep_their_values():
    for top, size in ((100, 1), (128, 2), (-32768, 2), (32768, 4), (-(1 << 31), 4), (1 << 31, 8), (-(1 << 52), 8)):
        v = np.array([[0, top, 1], [-1, 5, -7]], np.int64)
        data = topk.packed(v)
        assert len(data) == 6 * size and (topk.unpacked(data, 2, 3) == v).all()
    assert topk.unpacked(topk.packed(np.zeros((2, 0), np.int64)), 2, 0).shape == (2, 0)
