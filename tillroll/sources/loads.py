"""Loading a landing folder file by file, with a record of what was loaded.

A load takes the files that the record does not hold in their present version (path,
size, modification time), stages their rows as one semi-structured `raw_data` value each
and then writes the record: per file how many rows were loaded and rejected, and whether
anything could be read of it.

* **Stage**: one folder per load (`load_id=…`), replaced as a whole. Its rows keep the
  file they came from; a line that is no JSON stays as text with a NULL `raw_data`.
* **Record**: one folder per load, written last. A load that broke off has no record, so
  the next one has its number, replaces its stage folder and takes the same files.
* Loading twice adds nothing. A changed file is loaded again and its earlier rows are no
  longer current; a file that is gone keeps its rows.
* A file of which nothing can be read is skipped, with an entry, and not tried again
  until it changes. A file that breaks off in the middle is loaded as far as it goes. A
  file of no bytes has no entry before something is written to it.

Nothing is listed or counted row by row on the driver: the file list is a DataFrame
(`binaryFile` without its content), the record is anti-joined, counts come from the
stage as written (not from accumulators). A load reads no file older than its oldest new
one. One loader works on a landing folder at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

RECORD_SCHEMA = ("file string, modified timestamp, size long, status string, rows_loaded long, "
                 "rows_rejected long, load_id long")
STAGE_SCHEMA = "file string, raw_data variant, line string, accepted boolean, load_id long"
LOADED, SKIPPED = "loaded", "skipped"


@dataclass
class FolderLoad:
    """One landing folder and the stage and record kept for it below `root`.

    `fmt` is `text` (JSON lines) or `parquet` with `schema`; `json_column` names a
    Parquet column that holds JSON text, without it a whole row becomes the value."""
    spark: SparkSession
    landing: str
    root: str
    fmt: str = "text"
    schema: T.StructType | None = None
    json_column: str | None = None

    @property
    def stage_path(self) -> str:
        return f"{self.root}/stage"

    @property
    def record_path(self) -> str:
        return f"{self.root}/record"

    def listing(self) -> DataFrame:
        """(file, modified, size) of what lies in the landing folder now."""
        return (self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .load(self.landing)
                .select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_modification_time").alias("modified"),
                        F.col("_metadata.file_size").alias("size")))

    def record(self) -> DataFrame:
        """One row per file and load."""
        try:
            return self.spark.read.schema(RECORD_SCHEMA).parquet(self.record_path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], RECORD_SCHEMA)

    def new_files(self) -> DataFrame:
        """Files that the record does not hold in their present version."""
        return self.listing().join(self.record().select("file", "modified", "size"),
                                   ["file", "modified", "size"], "left_anti")

    def _rows(self, since: str | None) -> DataFrame:
        """(file, raw_data, line) of the files changed since then, unreadable ones left out."""
        reader = self.spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True)
        if since:
            reader = reader.option("modifiedAfter", since).option("timeZone", "UTC")
        file = F.col("_metadata.file_path").alias("file")
        if self.fmt == "text":
            raw = reader.text(self.landing).select(file, F.col("value").alias("line"))
        else:
            raw = reader.schema(self.schema).parquet(self.landing)
            if self.json_column is None:
                value = F.to_variant_object(F.struct(*[f.name for f in self.schema.fields]))
                return raw.select(file, value.alias("raw_data"), F.lit(None).cast("string").alias("line"))
            raw = raw.select(file, F.col(self.json_column).alias("line"))
        staged = F.col("raw_data").isNull()
        return raw.withColumn("raw_data", F.try_parse_json("line")).select(
            "file", "raw_data", F.when(staged, F.col("line")).alias("line"))

    def load(self) -> int | None:
        """Loads what is new; the load's number, None if there was nothing."""
        new = self.new_files()
        first = new.agg(F.min("modified").alias("modified")).first()["modified"]
        if first is None:
            return None
        last = self.record().agg(F.max("load_id")).first()[0]
        load_id = (last or 0) + 1
        since = None
        if last:
            # the option keeps files strictly later, in whole seconds
            since = new.agg(F.date_format(F.min("modified") - F.expr("INTERVAL 1 SECOND"),
                                          "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
        # the list of new files is taken down first: it decides what this load holds
        new = self._kept(new, f"{self.root}/new_files")
        stage = f"{self.stage_path}/load_id={load_id}"
        (self._rows(since).join(new.select("file"), "file", "left_semi")
         .withColumn("accepted", F.col("raw_data").isNotNull())
         .select("file", "raw_data", "line", "accepted").write.mode("overwrite").parquet(stage))
        found = (self.spark.read.schema("file string, accepted boolean").parquet(stage).groupBy("file")
                 .agg(F.count_if("accepted").alias("_ok"), F.count_if(~F.col("accepted")).alias("_bad")))
        status = F.when(F.col("_ok").isNotNull(), LOADED).otherwise(SKIPPED)
        (new.join(found, "file", "left")
         .select("file", "modified", "size", status.alias("status"),
                 F.coalesce("_ok", F.lit(0)).alias("rows_loaded"),
                 F.coalesce("_bad", F.lit(0)).alias("rows_rejected"))
         .write.mode("overwrite").parquet(f"{self.record_path}/load_id={load_id}"))
        return load_id

    def _kept(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def current(self) -> DataFrame:
        """(file, load_id): the load that holds each file's rows."""
        return self.record().filter(F.col("status") == LOADED).groupBy("file").agg(
            F.max("load_id").alias("load_id"))

    def stage(self, load_id: int | None = None) -> DataFrame:
        """Current staged rows, `accepted` or not; of one load with `load_id`."""
        rows = self.spark.read.schema(STAGE_SCHEMA).parquet(self.stage_path)
        if load_id is not None:
            rows = rows.filter(F.col("load_id") == F.lit(load_id))
        return rows.join(self.current(), ["file", "load_id"], "left_semi")

    def typed(self, schema: T.StructType, load_id: int | None = None) -> DataFrame:
        """The accepted rows as typed columns."""
        return files.from_variant_stage(self.stage(load_id).filter("accepted"), schema)
