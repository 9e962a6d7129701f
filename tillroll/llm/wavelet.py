"""The token file format: a wavelet matrix of one shard's ids with its document table.

Bit plane 0 holds the top bit of every id in order; the next plane holds the next bit of
the ids in stable order of the bit before (zeros first), and so on. With the number of
ones before each block (rank) every question about the sequence is answered from the
planes: the id at a place, how often an id occurs before a place, and where its k-th
occurrence is (select), without the sequence itself.

Layout, little-endian: MAGIC; uint64 ids, uint32 planes, uint32 documents; uint64 byte
sizes of the document table; zeros of every plane (uint64); per plane and block its ones
before (uint64) and the end of its bytes (uint64); the document table (doc_id int64,
length uint64, 1 byte for a NULL id; zstd); the blocks, each of BLOCK bits by zstd.
A question touches one block per plane and place.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WVMX0001"
SHIFT = 17
BLOCK = 1 << SHIFT
LEVEL = 1
_HEAD = "<QIIQ"


def build(ids: np.ndarray, width: int, doc_ids: list, lengths: list[int]) -> bytes:
    """One file from a shard's unsigned ids and its documents in order."""
    n, shrink = len(ids), zstandard.ZstdCompressor(level=LEVEL).compress
    zeros, marks, blocks, end = [], [], [], 0
    for plane in range(width):
        bits = (ids & ids.dtype.type(1 << (width - 1 - plane))) != 0
        zeros.append(n - int(np.count_nonzero(bits)))
        ones = 0
        for at in range(0, n, BLOCK):
            part = bits[at:at + BLOCK]
            blocks.append(shrink(np.packbits(part)))
            end += len(blocks[-1])
            marks += [ones, end]
            ones += int(np.count_nonzero(part))
        ids = np.concatenate([ids[~bits], ids[bits]])
    table = shrink(b"".join([
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array(lengths, "<u8").tobytes(), bytes(d is None for d in doc_ids)]))
    return b"".join([MAGIC, struct.pack(_HEAD, n, width, len(doc_ids), len(table)),
                     np.array(zeros, "<u8").tobytes(), np.array(marks, "<u8").tobytes(), table, *blocks])


class Reader:
    """Answers from a file's bytes; positions are within the file."""

    def __init__(self, data: bytes):
        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        at = len(MAGIC) + struct.calcsize(_HEAD)
        self.n, self.width, self.n_docs, table = struct.unpack_from(_HEAD, data, len(MAGIC))
        n_blocks = -(-self.n // BLOCK)
        self.zeros = np.frombuffer(data, "<u8", self.width, at).astype(np.int64)
        at += 8 * self.width
        marks = np.frombuffer(data, "<u8", 2 * self.width * n_blocks, at).astype(np.int64)
        at += 16 * self.width * n_blocks
        self.ones, self.ends = marks.reshape(self.width, n_blocks, 2).transpose(2, 0, 1)
        self.grow = zstandard.ZstdDecompressor().decompress
        self.data, self.table, self.blocks = data, (at, at + table), at + table

    def documents(self) -> tuple[list, np.ndarray]:
        """Document ids (None for NULL) and lengths, in order."""
        raw = self.grow(self.data[slice(*self.table)])
        ids = np.frombuffer(raw, "<i8", self.n_docs).tolist()
        null = raw[16 * self.n_docs:]
        return ([None if z else i for i, z in zip(ids, null)],
                np.frombuffer(raw, "<u8", self.n_docs, 8 * self.n_docs).astype(np.int64))

    def _bits(self, plane: int, block: int) -> np.ndarray:
        flat = plane * self.ends.shape[1] + block
        begin = self.ends.ravel()[flat - 1] if flat else 0
        raw = self.grow(memoryview(self.data)[self.blocks + begin:self.blocks + self.ends[plane, block]])
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=min(BLOCK, self.n - block * BLOCK))

    def _look(self, plane: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The plane's bit at each place (0 beyond the end) and its ones before it."""
        block = at >> SHIFT
        slot = np.zeros(self.ends.shape[1] + 1, np.int64)
        touched = np.flatnonzero(np.bincount(block, minlength=len(slot)))
        slot[touched] = np.arange(len(touched)) << SHIFT
        bits = np.zeros(len(touched) << SHIFT, np.uint8)
        ones = np.zeros(len(touched) << SHIFT, np.int32)
        total = self.n - int(self.zeros[plane])
        for s, b in zip(slot[touched].tolist(), touched.tolist()):
            if b << SHIFT >= self.n:
                ones[s:s + BLOCK] = total
                continue
            part = self._bits(plane, b)
            bits[s:s + len(part)] = part
            ones[s] = self.ones[plane, b]
            run = self.ones[plane, b] + np.cumsum(part, dtype=np.int32)[:BLOCK - 1]
            ones[s + 1:s + 1 + len(run)] = run
            ones[s + 1 + len(run):s + BLOCK] = total
        index = slot[block] + (at & (BLOCK - 1))
        return bits[index], ones[index]

    def access(self, at) -> np.ndarray:
        """The ids at the given places."""
        at = np.asarray(at, np.int64)
        if len(at) and not (0 <= at.min() and at.max() < self.n):
            raise IndexError("place beyond the file")
        value = np.zeros(len(at), np.uint32)
        for plane in range(self.width):
            bit, ones = self._look(plane, at)
            value = (value << np.uint32(1)) | bit
            at = np.where(bit, self.zeros[plane] + ones, at - ones)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        return self.access(np.arange(start, end))

    def everything(self) -> np.ndarray:
        """All ids: as `access`, with a table of every place's next place per plane."""
        value = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        at = np.arange(self.n, dtype=np.int32)
        place = at.copy()
        for plane in range(self.width):
            zeros = np.int32(self.zeros[plane])
            bits = np.concatenate([self._bits(plane, b) for b in range(self.ends.shape[1])]
                                  or [np.zeros(0, np.uint8)])
            ones = np.cumsum(bits, dtype=np.int32)  # itself included
            ahead = np.where(bits.view(bool), ones + (zeros - np.int32(1)), place - ones)
            at = ahead.take(at)
            value <<= value.dtype.type(1)
            value |= at >= zeros
        return value

    def _interval(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of `token` within start..end lie behind the last plane."""
        if token < 0 or token >> self.width:
            return 0, 0
        at = np.array([start, end], np.int64)
        for plane in range(self.width):
            _, ones = self._look(plane, at)
            one = token >> (self.width - 1 - plane) & 1
            at = self.zeros[plane] + ones if one else at - ones
        return int(at[0]), int(at[1])

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id within start..end (rank, for start 0)."""
        lo, hi = self._interval(token, start, self.n if end is None else end)
        return hi - lo

    def occurrences(self, token: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """The places of an id within start..end, ascending."""
        lo, hi = self._interval(token, start, self.n if end is None else end)
        at = np.arange(lo, hi)
        for plane in reversed(range(self.width)):
            one = token >> (self.width - 1 - plane) & 1
            at = self._select(plane, one, at - (int(self.zeros[plane]) if one else 0))
        return at

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence, from 0."""
        lo, hi = self._interval(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError("no such occurrence")
        at = np.array([lo + k])
        for plane in reversed(range(self.width)):
            one = token >> (self.width - 1 - plane) & 1
            at = self._select(plane, one, at - (int(self.zeros[plane]) if one else 0))
        return int(at[0])

    def _select(self, plane: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Places of the k-th `bit`s of a plane; k ascends."""
        if not len(k):
            return k
        before = self.ones[plane]
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, k, "right") - 1
        out = np.empty(len(k), np.int64)
        for b in np.unique(block):
            here = block == b
            places = np.flatnonzero(self._bits(plane, int(b)) == bit)
            out[here] = places[k[here] - before[b]] + int(b) * BLOCK
        return out
