"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

A document is its byte-level BPE ids and a closing id 0. Full windows of ``WINDOW`` ids
are cut off as they are; what is left of a document is cut into pieces of at most
``PIECE`` ids. Pieces are dealt at random into groups of about ``GROUP`` pieces, and in
each group the differencing method spreads them over ``ceil(tokens / WINDOW)`` windows:
it starts from one partial partition per piece and keeps merging the two with the
largest spread, fullest window of one onto the emptiest of the other, so that opposing
imbalances cancel. If a window ends up over capacity the count rises by one and the
group is dealt again. All groups are independent; a group's size does not depend on the
input's, and no ids are shuffled, only piece lengths and checksums.

The ids are those of the tokenizers library's file. They are computed per
whitespace-led chunk (the file's pre-tokenizer never joins a non-space with a following
space), from the same vocabulary as ranks, with a bounded cache of chunks; a text that
holds a special token's string or rare Unicode space goes through the tokenizers library
as a whole.

Defined cases: NULL text is empty and yields the single id 0; repeated rows are packed
each; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.materialize import written
from .common import text_of

WINDOW = 1024
PIECE = 256
GROUP = 1024
CACHE = 400_000
SLICE = 1 << 20

_CHUNK = re.compile(r"\s*\S+|\s+")
_TURN = re.compile(r"\S(?=\s)")
#: white space that the tokenizer's pattern and Python's ``\s`` may see differently
_RARE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"))


class Chunks(dict):
    """Chunk to little-endian uint32 ids. At CACHE chunks it is set aside and begun anew;
    chunks set aside come back when they are met again, so the frequent ones are encoded
    once while the rare ones go after one more round."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.aside = encode, {}
        self.pack = [struct.Struct(f"<{n}I").pack for n in range(33)]

    def __missing__(self, chunk: str) -> bytes:
        out = self.aside.get(chunk)
        if out is None:
            ids = self.encode(chunk)
            if len(ids) > 32:
                return np.array(ids, dtype="<u4").tobytes()
            out = self.pack[len(ids)](*ids)
        if len(self) >= CACHE:
            self.aside = dict(self)
            self.clear()
        self[chunk] = out
        return out


class Encoder:
    """Texts to little-endian uint32 ids, in blocks of bounded size."""

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(json_path)
        self.specials = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.chunks = Chunks(fast.encode_ordinary)

    def blocks(self, text: str) -> Iterator[bytes]:
        if _RARE.search(text) or any(s in text for s in self.specials):
            ids = self.full.encode(text, add_special_tokens=False).ids
            yield np.array(ids, dtype="<u4").tobytes()
            return
        get, start = self.chunks.__getitem__, 0
        while start < len(text):
            turn = _TURN.search(text, start + SLICE) if start + SLICE < len(text) else None
            end = turn.end() if turn else len(text)
            yield b"".join(map(get, _CHUNK.findall(text, start, end)))
            start = end


def kept_encoder(json_path: str, ranks_path: str) -> Encoder:
    """This worker process's encoder: workers are reused, so its chunks serve later tasks.
    This module is shipped by value with every task, so the library's holds it."""
    import tokenizers
    held = vars(tokenizers).setdefault("kept_chunk_encoders", {})
    if (json_path, ranks_path) not in held:
        held[json_path, ranks_path] = Encoder(json_path, ranks_path)
    return held[json_path, ranks_path]


def cut(blocks: Iterator[bytes], window: int, piece: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of a document's pieces from its ids and the closing id 0."""
    rest, start, wide = b"", 0, 4 * window

    def full():
        nonlocal rest, start
        view, at = memoryview(rest), 0
        while len(rest) - at >= wide:
            yield start, window, zlib.crc32(view[at:at + wide])
            at, start = at + wide, start + window
        rest = rest[at:]

    for block in blocks:
        rest += block
        yield from full()
    rest += b"\0\0\0\0"
    yield from full()
    for at in range(0, len(rest), 4 * piece):
        part = rest[at:at + 4 * piece]
        yield start, len(part) // 4, zlib.crc32(part)
        start += len(part) // 4


def piece_cutter(json_path: str, ranks_path: str, window: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(json_path, ranks_path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            doc, start, length, crc, total = [], [], [], [], []
            for i in range(batch.num_rows):
                found = list(cut(encoder.blocks(texts[i].as_py()), window, piece))
                n = found[-1][0] + found[-1][1]
                doc += [ids[i].as_py()] * len(found)
                total += [n] * len(found)
                s, le, c = zip(*found)
                start += s
                length += le
                crc += c
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: spread items over k windows with near-equal sums."""
    # a partial partition: its non-empty windows as (sum, items), fullest first
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over <= 0:  # the other's fullest windows meet empty ones
            merged = a + b
        else:  # emptiest of one onto the fullest of the other, b's other way round
            head, tail = a[:len(a) - over], a[len(a) - over:]
            both = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(tail, reversed(b[len(b) - over:]))]
            merged = head + b[:len(b) - over] + both
        merged.sort(key=lambda x: -x[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        tie += 1
        heapq.heappush(heap, (-spread, tie, merged))
    return [items for _, items in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows within capacity; the count rises until the differencing fits."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = difference(sizes, k)
        if max(sum(sizes[i] for i in w) for w in dealt) <= capacity:
            return dealt
        k += 1


def group_packer(window: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "start", "tag"],
                                  ascending=[False, True, True, True]).reset_index(drop=True)
        sizes = frame["length"].to_numpy()
        n_full = int((sizes == window).sum())
        seq, off = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
        seq[:n_full] = np.arange(n_full)
        small = sizes[n_full:].tolist()
        if small:
            for j, items in enumerate(windows(small, window)):
                at = 0
                for i in sorted(items):
                    seq[n_full + i], off[n_full + i] = n_full + j, at
                    at += small[i]
        frame["sequence_id"] = seq + (frame["grp"].to_numpy() << 24)
        frame["offset"] = off
        return frame[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         piece: int = PIECE, group: int = GROUP, json_path: str | None = None,
         ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if json_path is None or ranks_path is None:
        json_path, ranks_path = default_paths()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
              .mapInArrow(piece_cutter(json_path, ranks_path, window, piece), schema)
              .withColumn("tag", F.monotonically_increasing_id()))
    pieces = written(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group))
    # the row number, not the document, deals pieces out: copies spread over all groups
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("tag"), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(
        group_packer(window), schema + ", sequence_id long, offset long")
