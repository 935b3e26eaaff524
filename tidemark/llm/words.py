"""Words and word shingles of whole Arrow batches, as numpy arrays.

Texts are read as the bytes of one Arrow buffer.  A word is a maximal run of bytes that a
256-entry table accepts and never crosses a text; all other bytes separate words.  Every word
gets a 64-bit hash, a polynomial over random byte values finished by a mixer, so equal words
have equal hashes; two different words share one with a chance of about 2**-64.

A null text counts as the empty text.  Very long texts are hashed piece by piece.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_PIECE = 1 << 20
_RANDOM = np.random.default_rng(20260)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) * _U(2) + _U(1)


def byte_table(word_bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(word_bytes)] = True
    return table


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = byte_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class _Powers:
    """Powers of the base and of its inverse, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, _PIECE + 1)
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (np.multiply.accumulate(
                np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (_BASE, inverse))
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """The words of ``n`` texts: byte spans in ``data`` and the number of each one's text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, and one more at the end: its first word
    n: int

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts())

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        a = 0
        while a < len(out):
            lo = int(self.starts[a])
            b = max(a + 1, int(np.searchsorted(self.ends, lo + _PIECE, "right")))
            hi = int(self.ends[b - 1])
            up, down = _POWERS.upto(hi - lo)
            total = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.data[lo:hi]] * up[:hi - lo], out=total[1:])
            s, e = self.starts[a:b] - lo, self.ends[a:b] - lo
            out[a:b] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            a = b
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the ``n + 1`` offsets of a string column without its nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def words(column: pa.Array, table: np.ndarray, lower: bool = True) -> Words:
    data, at = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = table[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    begins, stops = at[:-1], at[1:]
    before[begins] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[stops] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at).astype(np.int64), len(at) - 1)


def shingles(w: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of all shingles of ``k`` words, in order of their first word.

    A text of fewer words, but not none, has its whole sequence as its one shingle.
    """
    counts = w.counts()
    m = len(hashes) - k + 1
    if m > 0:
        h = hashes[:m] * _PLACE[0]
        for j in range(1, k):
            h = h + hashes[j:j + m] * _PLACE[j]
        text = w.text_of()
        at = np.flatnonzero(text[:m] == text[k - 1:])
        h = mix(h[at] + _U(k))
    else:
        at, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        more, first = [], w.first[short]
        for c in range(1, k):
            here = first[counts[short] == c]
            s = np.zeros(len(here), np.uint64)
            for j in range(c):
                s = s + hashes[here + j] * _PLACE[j]
            more.append((here, mix(s + _U(c))))
        at = np.concatenate([at, *(a for a, _ in more)])
        h = np.concatenate([h, *(b for _, b in more)])
        order = np.argsort(at, kind="stable")
        at, h = at[order], h[order]
    return h, at


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, also of those that cross texts."""
    m = len(hashes) - k + 1
    h = hashes[:m] * _PLACE[0]
    for j in range(1, k):
        h = h + hashes[j:j + m] * _PLACE[j]
    return mix(h + _U(k))


def span_hashes(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of words of any lengths."""
    up, down = _POWERS.upto(len(hashes))
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    return mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = words(column, NOT_SPACE)
    h, at = shingles(w, w.hashes(), k)
    cut = np.searchsorted(at, w.first)
    for i in range(w.n):
        yield np.unique(h[cut[i]:cut[i + 1]])


def _trimmer():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not this C library
        return lambda _: 0


_trim = _trimmer()


def release() -> None:
    """Gives memory that is free, but still held by this worker, back to the machine."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def pieces(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``most`` bytes, or one longer text.

    Workers live on from stage to stage; after each batch they let go of what it took.
    """
    column = batch.column(text)
    _, at = text_bytes(column)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b
    release()
