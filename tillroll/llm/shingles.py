"""Word shingles of many texts at once in numpy: 64-bit hashes of A-Z-lowered words
(split at ASCII white space) and of runs of k words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 22

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


class Hasher:
    """Tables for texts of up to `size` bytes; grows when a longer one comes."""

    def __init__(self):
        rng = np.random.default_rng(1)
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.byte[65:91] = self.byte[97:123]
        self.word = np.ones(256, bool)
        self.word[[32, 9, 10, 11, 12, 13]] = False
        self.grow(SLICE)

    def grow(self, size: int) -> None:
        self.power = np.full(size, _U(_BASE))
        self.power[0] = 1
        self.power = np.multiply.accumulate(self.power)
        self.back = np.full(size, _U(_INVERSE))
        self.back[0] = 1
        self.back = np.multiply.accumulate(self.back)

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of concatenated texts and the number of words of each text."""
        if len(data) > len(self.power):
            self.grow(len(data))
        inside = self.word[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = np.concatenate([[0], ends[:-1]])
        begins = begins[begins < len(data)]
        first[begins] = inside[begins]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        stops = ends[ends > 0] - 1
        last[stops] = inside[stops]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(len(data) + 1, _U)
        np.cumsum(self.byte[data] * self.power[:len(data)], out=total[1:])
        h = (total[stop] - total[start]) * self.back[start]
        counts = np.diff(np.searchsorted(start, np.concatenate([[0], ends])))
        return mix(h + (stop - start).astype(_U) * _U(0xE7037ED1A0B428DB)), counts


def shingle_sets(words: np.ndarray, counts: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; of a shorter text's whole
    sequence; empty without words."""
    run = np.zeros(max(0, len(words) - k + 1), _U)
    salt = [mix(np.array([i + 1], _U))[0] | _U(1) for i in range(k)]
    for i in range(k):
        run += words[i:len(words) - k + 1 + i] * salt[i] if len(run) else run
    run = mix(run)
    at = 0
    for n in counts.tolist():
        if n >= k:
            s = np.sort(run[at:at + n - k + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif n:
            whole = sum((words[at + i:at + i + 1] * salt[i] for i in range(n)), np.zeros(1, _U))
            yield mix(whole + _U(n) * _U(0x8EBC6AF09C88C6E3))
        else:
            yield run[:0]
        at += n


def batch_sets(texts: pa.Array, k: int, hasher: Hasher) -> Iterator[np.ndarray]:
    """Shingle sets of a string array, worked through in slices of about SLICE bytes."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        part = data[offsets[i]:offsets[j]]
        words, counts = hasher.words(part, offsets[i + 1:j + 1] - offsets[i])
        yield from shingle_sets(words, counts, k)
        i = j
