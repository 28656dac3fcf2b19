"""Whole-column text work in numpy, for use inside Arrow map tasks.

Words are maximal runs of bytes other than ``[\\x20\\x09-\\x0D]``; a word never spans two documents.
Every array is built for one bounded slice of a batch, so a task's memory follows ``SLICE_BYTES``
(or the longest single text), not its partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240517).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1), base, dtype=np.uint64)
        step[0] = 1
        have = np.cumprod(step, dtype=np.uint64)
        if n <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row; a null row has no bytes."""
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def give_back() -> None:
    """Return this worker's freed memory to the system: Arrow's pool, and the C heap where its library can (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds at most ``limit`` bytes of text, or one row.

    Freed memory goes back to the system at the end of a task, as a worker lives on between stages and what it keeps
    counts against its executor.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, at = bytes_of(batch.column(batch.schema.get_field_index(text)))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(at, at[row] + limit, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end
    give_back()


def _hash_spans(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each span [first, last) of a slice."""
    if len(first) == 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * _power(_BASE, len(data)), out=total[1:])
    h = (total[last] - total[first]) * _power(_BASE_INVERSE, len(data))[first]
    return mix(h + (last - first).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word and, per document, the number of its first word (length rows + 1)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    ink = ~WHITE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    opens = ink.copy()
    opens[1:] &= ~ink[:-1] | cut[1:n]
    closes = ink.copy()
    closes[:-1] &= ~ink[1:] | cut[1:n]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if lower:
        data = LOWER[data]
    if n <= 2 * SLICE_BYTES:
        h = _hash_spans(data, first, last)
    else:  # one very long text: hash runs of words, so that the power tables stay small
        h, k = np.empty(len(first), np.uint64), 0
        while k < len(first):
            m = max(int(np.searchsorted(last, first[k] + SLICE_BYTES, "right")), k + 1)
            a, b = first[k], last[m - 1]
            h[k:m] = _hash_spans(data[a:b], first[k:m] - a, last[k:m] - a)
            k = m
    return first, last, h, np.searchsorted(first, offsets)


def owner(starts: np.ndarray) -> np.ndarray:
    """Row number of each element, from the rows' first-element numbers."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def ngrams(h: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each row's sequence, and the rows' first n-gram numbers."""
    sizes = np.maximum(np.diff(starts) - n + 1, 0)
    out = np.concatenate(([0], np.cumsum(sizes)))
    if out[-1] == 0:
        return np.zeros(0, np.uint64), out
    whole = len(h) - n + 1
    g = np.zeros(whole, np.uint64)
    for k in range(n):
        g *= _U(0xC2B2AE3D27D4EB4F)
        g += h[k : k + whole]
    if len(sizes) > 1:
        keep = np.ones(whole, bool)
        for at in starts[1:-1]:
            keep[max(at - n + 1, 0) : at] = False
        # rows shorter than n leave no n-gram of their own; their positions fall to the cuts above
        g = g[keep]
    return mix(g), out
