"""Lineage cuts as written tables in the shared checkpoint folder.

`Dataset.checkpoint()` runs its input twice (once for the action, once for the
checkpoint write) unless the input is also cached. Writing Parquet once and
reading it back costs one computation, survives executor loss (the files live
in the shared folder named by ``spark.checkpoint.dir``), and gives later stages
column pruning and filter pushdown on the written table.

Nothing reads the shuffle files of such a write again, so they go when it ends
(`shuffles_given_up`) instead of whenever the driver collects its garbage: the disk
holds the shuffles of the writes under way, not those of the whole session.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
_HOLDS: dict[int, list] = {}  # by session: writes under way, the setting before them


@contextmanager
def shuffles_given_up(spark: SparkSession):
    """Writes that start inside leave no shuffle files; a stage that is run again makes
    them anew. The setting returns to what it was when the last of several threads ends."""
    with _LOCK:
        hold = _HOLDS.setdefault(id(spark), [0, spark.conf.get(_CLEANUP, None)])
        hold[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            hold[0] -= 1
            if not hold[0]:
                del _HOLDS[id(spark)]
                if hold[1] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, hold[1])


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_given_up(df.sparkSession):
        w.parquet(path)
    reader = df.sparkSession.read
    if partition_by:
        reader = reader.schema(df.schema)
    return reader.parquet(path).select(*df.columns)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def discard(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder that `written` or a sink made and nothing reads any more.
    Only folders below the session's scratch tables are removed."""
    base = spark.sparkContext.getCheckpointDir()
    fs, where = _file_system(spark, path)
    if base and where.toUri().getPath().startswith(
            _file_system(spark, base)[1].toUri().getPath().rstrip("/") + "/tables/"):
        fs.delete(where, True)


def release(*tables: DataFrame) -> None:
    """Discards `written` tables that nothing reads any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            discard(df.sparkSession, folder)


def reads_below(df: DataFrame, root: str) -> bool:
    """Whether files below the folder `root` are among those that `df` reads."""
    folder = _file_system(df.sparkSession, root)[1].toUri().getRawPath().rstrip("/") + "/"
    return any(folder in f for f in df.inputFiles())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of a table that its caller keeps (a partition without rows)."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def folder_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(files, bytes, newest change in ms) below `path`: differs once files are added,
    removed or replaced. Works on any store Spark reads."""
    fs, where = _file_system(spark, path)
    files = size = newest = 0
    todo = [where]
    while todo:
        for s in fs.listStatus(todo.pop()):
            if s.isDirectory():
                todo.append(s.getPath())
            else:
                files, size = files + 1, size + s.getLen()
                newest = max(newest, s.getModificationTime())
    return files, size, newest
