"""Vectorised text primitives used inside Arrow tasks.

A chunk is a run of whole texts laid out in one byte buffer. Words, n-grams
and their 64-bit hashes come from a few numpy passes over that buffer, so
the cost per byte does not depend on the number of words or documents. The
hash of bytes s..e is polynomial: with P the prefix sums of value(byte) *
BASE**position (mod 2**64), it is (P[e] - P[s]) * BASE**-s, mixed at the end.
Byte values are drawn at random once, which removes the known weak strings of
such hashes. Equal byte strings have equal hashes in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse mod 2**64
BASE_INV = pow(BASE, -1, 1 << 64)
BYTE_VALUE = np.random.default_rng(20240817).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
CHUNK_BYTES = 1 << 19

# ASCII white space: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Everything outside digits, a-z and non-ASCII bytes (upper case is folded first).
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_powers = {"n": 0, "fwd": np.empty(0, U64), "inv": np.empty(0, U64)}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, kept for the life of the worker."""
    if _powers["n"] < n:
        size = max(n, 2 * CHUNK_BYTES)
        for name, b in (("fwd", BASE), ("inv", BASE_INV)):
            p = np.full(size, U64(b), U64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
        _powers["n"] = size
    return _powers["fwd"], _powers["inv"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads the polynomial hash over all bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Chunk:
    """Whole texts in one buffer: ``buf[offsets[i]:offsets[i + 1]]`` is text i."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, first: int, lower: bool = False):
        self.first = first  # row number of the first text within its batch
        self.raw = buf
        self.buf = LOWER[buf] if lower else buf
        self.offsets = offsets.astype(np.int64)
        self.n = len(offsets) - 1
        self._prefix = None

    @property
    def prefix(self) -> np.ndarray:
        if self._prefix is None:
            fwd, _ = _power_table(len(self.buf) + 1)
            p = np.zeros(len(self.buf) + 1, U64)
            np.cumsum(BYTE_VALUE[self.buf] * fwd[:len(self.buf)], out=p[1:])
            self._prefix = p
        return self._prefix

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges."""
        _, inv = _power_table(len(self.buf) + 1)
        p = self.prefix
        return mix((p[ends] - p[starts]) * inv[starts])

    def words(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first) of the maximal runs of non-separators; text i has words first[i]:first[i + 1]."""
        inside = ~separators[self.buf]
        if not len(inside):
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(self.n + 1, np.int64)
        cut = np.zeros(len(inside) + 1, bool)  # a text boundary ends a word
        cut[self.offsets] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | cut[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | cut[1:-1]
        s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return s, e, np.searchsorted(s, self.offsets)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The text number each byte position lies in."""
        return np.searchsorted(self.offsets, positions, side="right") - 1


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def chunks(col: pa.Array, lower: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into chunks of whole texts of about ``chunk_bytes``; a longer text is a chunk of its own."""
    if not len(col):
        return
    buf, offsets = column_bytes(col)
    i, n = 0, len(col)
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + chunk_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield Chunk(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], i, lower)
        i = j


def windows(first: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All k-word windows: (text, first word, last word + 1).

    With ``short``, a text of fewer than k words, but not none, is one window.
    """
    n = np.diff(first)
    per = np.maximum(n - k + 1, 0)
    if short:
        per = np.where((n > 0) & (n < k), 1, per)
    text = np.repeat(np.arange(len(n)), per)
    base = np.cumsum(per) - per
    begin = np.arange(len(text)) - base[text] + first[text]
    return text, begin, np.minimum(begin + k, first[text + 1])


def sequence_hash(word_hash: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of word sequences, from the hashes of their words."""
    fwd, inv = _power_table(len(word_hash) + 1)
    p = np.zeros(len(word_hash) + 1, U64)
    np.cumsum(mix(word_hash + U64(0x632BE59BD9B4E019)) * fwd[:len(word_hash)], out=p[1:])
    return mix(((p[end] - p[begin]) * inv[begin]) ^ (end - begin).astype(U64))


def sum_by(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, weights=values, minlength=n)
