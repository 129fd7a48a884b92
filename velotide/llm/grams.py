"""Word and n-gram hashes of whole Arrow string batches, vectorised in numpy.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D`` (these bytes
never occur inside a multi-byte UTF-8 character).  A word's hash is a
polynomial hash of its bytes modulo 2**64, taken from prefix sums, so the cost
is a few array passes per byte and no Python object per word.  Texts are
handled in groups of about ``GROUP_BYTES`` so that the arrays stay small
however long a batch is; a single longer text forms its own group."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
_RNG = np.random.default_rng(20240229)
_TABLE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER_TABLE = _TABLE.copy()
_LOWER_TABLE[65:91] = _TABLE[97:123]
_SECOND_TABLE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SECOND_TABLE[65:91] = _SECOND_TABLE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


_P, _Q = _powers(_BASE, GROUP_BYTES), _powers(_INVERSE, GROUP_BYTES)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _P, _Q
    if len(_P) <= n:
        return _powers(_BASE, n), _powers(_INVERSE, n)
    return _P, _Q


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_string())


def groups(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets within them) of consecutive rows."""
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP_BYTES, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, second: bool = False):
    """Hashes of all words, their first and end byte, and for each row the index
    of its first word (one more entry at the end).  No word crosses rows.
    ``second`` gives other, independent hashes of the words in lower case."""
    gap = _SPACE[data]
    prev = np.ones(len(data), bool)
    prev[1:] = gap[:-1]
    cut = offsets[1:-1]
    prev[cut[cut < len(data)]] = True          # a row's first byte starts a word
    starts = np.flatnonzero(~gap & prev)
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    after[cut[(cut > 0)] - 1] = True
    ends = np.flatnonzero(~gap & after) + 1
    p, q = _grown(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_SECOND_TABLE if second else _LOWER_TABLE if lower else _TABLE)[data] * p[:len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * q[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (len - n + 1 of them); windows
    that cross rows are the caller's to leave out."""
    size = max(0, len(hashes) - n + 1)
    with np.errstate(over="ignore"):
        out = np.zeros(size, np.uint64)
        for k in range(n):
            out = mix(out * np.uint64(0x2545F4914F6CDD1D) + hashes[k:k + size] + np.uint64(k + 1))
    return out


def row_shingles(hashes: np.ndarray, windows: np.ndarray, first: int, end: int, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles of words first..end; a shorter text is one
    shingle of all its words; without words empty."""
    if end - first >= n:
        return np.unique(windows[first:end - n + 1])
    if end == first:
        return np.zeros(0, np.uint64)
    return chained(hashes[first:end], end - first)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of every row; null texts have none."""
    for i, j, data, offsets in groups(texts):
        hashes, _, _, firsts = words(data, offsets)
        windows = chained(hashes, n)
        for k in range(i, j):
            yield k, row_shingles(hashes, windows, firsts[k - i], firsts[k - i + 1], n)
