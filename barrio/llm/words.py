"""Words of Arrow text columns as numpy arrays.

A word is a run of bytes outside space and 0x09-0x0D.  Texts are hashed
straight from the Arrow buffer: no Python string is made.  Two words are
taken as equal when their 64-bit hashes are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE = 1 << 20          # bytes hashed at a time
CHUNK = 1 << 21          # bytes of whole texts handled at a time

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)

_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[list(SEPARATORS)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """An invertible scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _BASE)
LOWER = _BYTE.copy()
LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


class PrefixHash:
    """Hashes of any range of a 64-bit sequence from one running sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self.run[1:])
        self.back = powers(_UNBASE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.run[end] - self.run[start]) * self.back[start]
                   + (end - start).astype(np.uint64) * _RIGHT)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """Hashes of byte ranges in ascending order, about SLICE bytes at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(out):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + SLICE, "right")))
        out[i:j] = PrefixHash(table[data[at:ends[j - 1]]]).of(starts[i:j] - at, ends[i:j] - at)
        i = j
    return out


class Words:
    """Words of consecutive texts: hashes, byte ranges and each text's first word.

    ``bounds[d]:bounds[d+1]`` are the words of text ``d``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = ~_IS_SEP[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hash = range_hashes(data, self.starts, self.ends, LOWER if lower else _BYTE)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        """Of each word, its text's number."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def join2(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of concatenations from the hashes of their parts."""
    return mix(left * _LEFT + right * _RIGHT + _BASE)


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` values (``len(values) - k + 1`` of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out, width, block, have = None, 0, values, 1
    while have <= k:
        if k & have:
            part = block[width:]
            out = part if out is None else join2(out[:len(part)], part[:len(out)])
            width += have
        if have * 2 <= k:
            block = join2(block[:-have], block[have:])
        have *= 2
    return out[:n]


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the offsets of each; null is the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with at most ``limit`` bytes of text (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, at = text_buffer(batch.column(column))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[at[i]:at[j]], at[i:j + 1] - at[i]
            i = j
