"""Numpy kernels over the bytes of an Arrow text column: words, hashes, code-point offsets.

All of them work on one slice of a batch at a time (``text_slices``), so memory is a
small multiple of the slice, whatever the size of the batch or the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_HASH_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: bytes of words: digits, letters and everything beyond ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

#: bytes of words: everything but white space
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[0x20] = NON_SPACE[0x09:0x0E] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 … base**(n-1)`` modulo 2**64, kept for later calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1024)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows one after the other, and row offsets; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows of at most ``limit`` bytes (one row if it alone is longer)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_buffer(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers are kept, and many tasks share an executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of ``table`` bytes inside a row."""
    inside = table[data]
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[firsts[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, np.repeat(np.arange(len(counts)), counts)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes; spans ascend and don't overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(int(np.searchsorted(ends, starts[lo] + _HASH_BLOCK, side="right")), lo + 1)
        origin, stop = int(starts[lo]), int(ends[hi - 1])
        sums = np.zeros(stop - origin + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data[origin:stop]] * powers(_BASE, stop - origin), out=sums[1:])
        s, e = starts[lo:hi] - origin, ends[lo:hi] - origin
        out[lo:hi] = (sums[e] - sums[s]) * powers(_INVERSE, stop - origin)[s] + (e - s).astype(np.uint64)
        lo = hi
    return mix(out)


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values; one per start, whatever rows they lie in."""
    if len(values) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(len(values) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = total * np.uint64(_BASE) + values[i : len(values) - n + 1 + i]
    return mix(total)


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of code points before each byte (and at the end), counted over the slice."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """List column from values in row order and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def blobs(raw: bytes | memoryview, offsets: np.ndarray) -> pa.Array:
    """Binary column whose rows are consecutive parts of ``raw``."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(raw)]).cast(pa.binary())
