"""The registered queries: oracles, whole tables and the pipeline against plain stages."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from tillroll.llm import exact_dedup, mixing, near_dedup, packing, quality
from tillroll.llm.oracle import oracle_sql
from tillroll.llm.queries import QUERIES

FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    want = sorted(str([r[names.index(c)] for c in cols]) for r in cur.fetchall())
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == cols
    assert sorted(str(list(r)) for r in got.select(*cols).collect()) == want


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert [f"op{n}" for n in range(1, 14)] == sorted(
        {q.split("_")[0] for q in QUERIES if q.startswith("op")}, key=lambda x: int(x[2:]))


@pytest.mark.parametrize("name", ["op2_line_dedup", "op3_language_id", "op4_secret_scan", "op7_license_scan",
                                  "op8_near_dedup", "op10_quality", "op13_token_files"])
def test_query_covers_its_table(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(r[0] for r in got.select("doc_id").distinct().collect()) == sorted(
        r[0] for r in docs.select("doc_id").collect())


def test_pipeline_stages_follow_each_other(spark):
    """Each stage by a plain rule from what the stage before kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages, kept = dict(corpus_pipeline.STAGES), {0: docs}
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        kept[i + 1] = f(spark, kept[i], SF_SMALL).cache()
        if i < len(stages) - 1:
            assert kept[i + 1].columns == docs.columns
    ids = {i: sorted(r[0] for r in kept[i].select("doc_id").collect()) for i in range(5)}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scored = quality.score(docs, labels).collect()
    assert ids[1] == sorted(r["doc_id"] for r in scored if r["predicted"])
    groups = {}
    for r in kept[1].collect():
        t = (r["text"] or "").translate(FOLD)
        groups[t] = max(groups.get(t, -1), r["doc_id"])
    assert ids[2] == sorted(groups.values())
    near = near_dedup.near_components(kept[2]).collect()
    assert ids[3] == sorted(r["doc_id"] for r in near if r["component_id"] == r["doc_id"])
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(kept[3], partial=False).collect()}
    assert ids[4] == sorted(i for i, n in copies.items() for _ in range(n))
    tokens = {r["doc_id"]: r["doc_tokens"] for r in packing.pack(kept[3]).collect()}
    assert sum(r["length"] for r in kept[5].collect()) == sum(tokens[i] for i in ids[4])
    assert exact_dedup.exact_dedup(kept[2]).filter("not kept").count() == 0

