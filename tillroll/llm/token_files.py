"""Token ids of a corpus in wavelet-matrix files, one per shard, and lookups in them.

Texts are encoded in the scan; ids and a row tag are written once, range-partitioned by
doc_id and sorted, so that files follow ascending doc_id. A task closes a shard when it
holds ``SHARD`` ids (whole documents; a longer document makes a longer shard) and hands
its file's bytes to Spark, which writes one Parquet file per shard and commits it: a lost
executor or a second attempt leaves no half file, and any store that Spark writes will do.
The payload of a file is described in ``wavelet``; beside it the row names its partition,
number, ids and the ids of the partition before it.

``document_index`` reads the files back; ``token_counts``, ``token_places`` and
``tokens_at`` answer from the files' planes, shard by shard. The first id of a partition
comes from a running sum over partitions (one small row each).

Ids are those of the tokenizers library. The file's normalizer and pre-tokenizer never
join across white space, so each run of other characters is encoded once and kept in a
bounded cache. Text of ASCII and Latin-1 letters, ASCII digits and punctuation is split
into words here and each word goes to the library's model; a run with any other character
or what may be a special token goes through the whole library.

Defined cases: NULL text is empty and holds the closing id alone; rows that repeat a
doc_id follow each other in the order of the input's partitions; NULL doc_ids come last; a text of any
length is encoded whole, in slices at white space; an empty table makes files without
documents and no rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.materialize import written
from ..session import scratch_path
from . import wavelet
from .common import text_of

END_ID = 2
SHARD = 1 << 22
CACHE = 300_000
SLICE = 1 << 20
BATCH = 32 << 20
_CHUNK = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_WHITE = re.compile(r"[ \t\n\r\x0b\x0c]")
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]+")
_LETTERS = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
#: the file's pre-tokenizer on lowered text of those characters
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
FILES = "part int, shard int, n_tokens long, before long, data binary"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Cache(dict):
    """Text to ids; emptied when it holds CACHE texts."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        out = self.encode(text)
        if len(text) <= 100:
            if len(self) >= CACHE:
                self.clear()
            self[text] = out
        return out


class Encoder:
    """Texts to packed little-endian ids."""

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer
        self.library, self.code = Tokenizer.from_file(path), np.dtype(dtype).char
        self.words, self.chunks = Cache(self.word), Cache(self.chunk)
        self.model = self.library.model
        # the letters that stand for a letter's bytes
        self.letters = {ord(c): self.library.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _LETTERS}

    def packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def word(self, word: str) -> bytes:
        """One piece of the pre-tokenizer: its bytes' letters, then the model."""
        if not word.isascii():
            word = word.translate(self.letters)
        return self.packed([t.id for t in self.model.tokenize(word)])

    def chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return b"".join(map(self.words.__getitem__, _WORD.findall(chunk.lower())))
        return self.packed(self.library.encode(chunk, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        get, start, out = self.chunks.__getitem__, 0, []
        while start < len(text):
            turn = _WHITE.search(text, start + SLICE) if start + SLICE < len(text) else None
            end = turn.end() if turn else len(text)
            part = text[start:end]
            if _PLAIN.fullmatch(part) and "<|" not in part:
                out.append(b"".join(map(self.words.__getitem__, _WORD.findall(part.lower()))))
            else:
                out.append(b"".join(map(get, _CHUNK.findall(part))))
            start = end
        return b"".join(out)


def kept_encoder(path: str, dtype: str) -> Encoder:
    """This worker process's encoder: workers are reused, so its words serve later tasks.
    This module is shipped by value with every task, so the library's holds it."""
    import tokenizers
    held = vars(tokenizers).setdefault("kept_encoders", {})
    if (path, dtype) not in held:
        held[path, dtype] = Encoder(path, dtype)
    return held[path, dtype]


def packed_type(width: int) -> str:
    return "<u2" if width <= 16 else "<u4"


def id_maker(path: str, end_id: int, dtype: str):
    """(doc_id, text) to (doc_id, ids): packed ids with the closing id."""
    closing = np.array([end_id], dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(path, dtype)
        for batch in batches:
            made, start, size = [], 0, 0

            def flush() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(made)), pa.array(made, pa.binary())], ["doc_id", "ids"])

            for text in batch.column(1):
                made.append(encoder.ids(text.as_py()) + closing)
                size += len(made[-1])
                if size >= BATCH:
                    yield flush()
                    start, made, size = start + len(made), [], 0
            if made:
                yield flush()
    return run


def shard_maker(width: int, shard: int):
    """Sorted (doc_id, ids) of one partition to rows of FILES."""
    dtype = np.dtype(packed_type(width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        docs, cells, size, number, before = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(cells), dtype)
            data = wavelet.build(ids, width, docs, [len(c) // dtype.itemsize for c in cells])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)]),
                 pa.array([before]), pa.array([data], pa.binary())],
                ["part", "shard", "n_tokens", "before", "data"])

        for batch in batches:
            for doc, ids in zip(batch.column(0), batch.column(1)):
                docs.append(doc.as_py())
                cells.append(ids.as_py())
                size += len(cells[-1]) // dtype.itemsize
                if size >= shard:
                    yield flush()
                    docs, cells, size, number, before = [], [], 0, number + 1, before + size
        if docs:
            yield flush()
    return run


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 json_path: str | None = None, end_id: int = END_ID, shard: int = SHARD) -> None:
    """Writes the files of all documents below `path`, replacing what is there."""
    from tokenizers import Tokenizer
    json_path = json_path or default_path()
    width = max(end_id, Tokenizer.from_file(json_path).get_vocab_size() - 1, 1).bit_length()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    made = written(texts.mapInArrow(id_maker(json_path, end_id, packed_type(width)), "doc_id long, ids binary")
                   .withColumn("tag", F.monotonically_increasing_id()), "token-ids")
    order = [F.col("doc_id").asc_nulls_last(), F.col("tag").asc()]
    placed = made.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    (placed.mapInArrow(shard_maker(width, shard), FILES)
     .write.mode("overwrite").option("compression", "uncompressed")
     .option("maxRecordsPerFile", 1).parquet(path))


def shards(spark: SparkSession, path: str) -> DataFrame:
    """Rows of FILES with the place of each file's first id in the corpus (`start`)."""
    files = spark.read.schema(FILES).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # one small row per shuffle partition
    return files.join(F.broadcast(parts), "part").select("*", (F.col("base") + F.col("before")).alias("start"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data in zip(batch.column(0), batch.column(1)):
            reader = wavelet.Reader(data.as_py())
            ids, lengths = reader.documents()
            raw = reader.everything().astype("<u4").tobytes()
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(start.as_py() + ends - lengths),
                 pa.array(lengths), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    return shards(spark, path).select("start", "data").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            json_path: str | None = None, end_id: int = END_ID, shard: int = SHARD) -> DataFrame:
    """The document index of `docs`, written to a scratch folder and read back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, id_col, text_col, json_path, end_id, shard)
    return document_index(docs.sparkSession, path)


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): occurrences of each of `tokens` in the corpus, from two ranks a plane."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(tokens, 0)
        for batch in batches:
            for data in batch.column(0):
                reader = wavelet.Reader(data.as_py())
                for t in total:
                    total[t] += reader.count(t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["token", "n"])

    found = spark.read.schema(FILES).parquet(path).select("data").mapInArrow(run, "token long, n long")
    asked = spark.createDataFrame([(t,) for t in dict.fromkeys(tokens)], "token long")
    return asked.join(found.groupBy("token").agg(F.sum("n").alias("n")), "token", "left").select(
        "token", F.coalesce("n", F.lit(0)).alias("n"))


def token_places(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, place, offset): every occurrence of an id, by its place in the corpus and
    in its document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0), batch.column(1)):
                reader = wavelet.Reader(data.as_py())
                at = reader.occurrences(token)
                ids, lengths = reader.documents()
                ends = np.cumsum(lengths)
                doc = np.searchsorted(ends, at, "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[d] for d in doc.tolist()], pa.int64()), pa.array(start.as_py() + at),
                     pa.array(at - (ends - lengths)[doc])], ["doc_id", "place", "offset"])

    return shards(spark, path).select("start", "data").mapInArrow(
        run, "doc_id long, place long, offset long")


def tokens_at(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """(place, token) for the corpus's ids from start up to end; only the files that hold
    some are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                reader = wavelet.Reader(data.as_py())
                places = np.arange(max(0, start - first), min(reader.n, end - first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places + first), pa.array(reader.access(places).astype(np.int64))],
                    ["place", "token"])

    held = (F.col("start") < end) & (F.col("start") + F.col("n_tokens") > start)
    return shards(spark, path).filter(held).select("start", "data").mapInArrow(run, "place long, token long")
