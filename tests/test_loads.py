"""The load record: loading twice, new, changed, broken, empty and vanished files."""

import gzip
import json
import os

import pytest
from pyspark.sql import types as T

from tillroll.sources.loads import FolderLoad

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])


def put(path, lines, when):
    path.parent.mkdir(parents=True, exist_ok=True)
    data = "".join(f"{x}\n" for x in lines).encode()
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    os.utime(path, (when, when))


def row(i, n=1):
    return json.dumps({"id": i, "n": n})


def entries(job):
    return sorted((r["load_id"], r["file"].rsplit("/", 1)[1], r["status"], r["rows_loaded"], r["rows_rejected"])
                  for r in job.record().collect())


def ids(job, load_id=None):
    return sorted((r["id"], r["n"]) for r in job.typed(SCHEMA, load_id).collect())


@pytest.fixture
def job(spark, tmp_path):
    put(tmp_path / "in" / "a" / "one.json", [row("a1"), "{broken", row("a2")], 1_700_000_000)
    put(tmp_path / "in" / "two.json.gz", [row("b1")], 1_700_000_500)
    return FolderLoad(spark, str(tmp_path / "in"), str(tmp_path / "state"))


FIRST = [(1, "one.json", "loaded", 2, 1), (1, "two.json.gz", "loaded", 1, 0)]


def test_a_second_load_finds_nothing(job):
    assert job.load() == 1 and entries(job) == FIRST
    assert job.load() is None and entries(job) == FIRST
    assert ids(job) == [("a1", 1), ("a2", 1), ("b1", 1)]
    assert [r["line"] for r in job.stage().filter("NOT accepted").collect()] == ["{broken"]


def test_new_broken_and_empty_files(job, tmp_path):
    job.load()
    put(tmp_path / "in" / "new file.json", [row("c1"), row("c2")], 1_700_000_900)  # a blank in the name
    (tmp_path / "in" / "bad.json.gz").write_bytes(b"this is no gzip data")
    put(tmp_path / "in" / "nothing.json", [], 1_700_000_900)
    assert job.load() == 2
    assert [e for e in entries(job) if e[0] == 2] == [
        (2, "bad.json.gz", "skipped", 0, 0), (2, "new%20file.json", "loaded", 2, 0)]
    assert ids(job, 2) == [("c1", 1), ("c2", 1)] and len(ids(job)) == 5
    assert job.load() is None
    put(tmp_path / "in" / "nothing.json", [row("d1")], 1_700_001_000)
    assert job.load() == 3 and len(ids(job)) == 6


def test_a_file_that_arrives_with_an_old_date_is_loaded(job, tmp_path):
    job.load()
    put(tmp_path / "in" / "late.json", [row("z")], 1_600_000_000)
    assert job.load() == 2 and ids(job, 2) == [("z", 1)] and len(ids(job)) == 4


def test_a_changed_file_replaces_its_rows(job, tmp_path):
    job.load()
    put(tmp_path / "in" / "two.json.gz", [row("b1", 5), row("b2")], 1_700_000_700)
    assert job.load() == 2
    assert ids(job) == [("a1", 1), ("a2", 1), ("b1", 5), ("b2", 1)]
    (tmp_path / "in" / "two.json.gz").unlink()
    assert job.load() is None and len(ids(job)) == 4


def test_a_load_that_broke_off_is_repeated(job, tmp_path, spark):
    job.load()
    put(tmp_path / "in" / "three.json", [row("c1")], 1_700_000_900)
    # the stage of load 2 was written, its record was not
    spark.createDataFrame([("x", "half", True)], "file string, line string, accepted boolean").write.parquet(
        f"{job.stage_path}/load_id=2")
    assert job.load() == 2 and ids(job, 2) == [("c1", 1)]


def test_parquet_rows_become_values(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("p", 3), (None, None)], SCHEMA).coalesce(1).write.parquet(f"{src}/good")
    spark.createDataFrame([("no parquet",)], "value string").coalesce(1).write.text(f"{src}/broken")
    job = FolderLoad(spark, src, str(tmp_path / "state"), "parquet", SCHEMA)
    assert job.load() == 1
    assert sorted((r["status"], r["rows_loaded"]) for r in job.record().collect()) == [("loaded", 2), ("skipped", 0)]
    assert sorted(map(str, job.typed(SCHEMA).collect())) == ["Row(id='p', n=3)", "Row(id=None, n=None)"]


def test_an_empty_landing_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    job = FolderLoad(spark, str(tmp_path / "in"), str(tmp_path / "state"))
    assert job.load() is None and job.record().count() == 0
