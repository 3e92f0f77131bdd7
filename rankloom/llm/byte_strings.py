"""Byte strings and words of texts as 64-bit keys, and their counts by shard; shared by the language models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from rankloom.llm.kernels import LOWER, NON_SPACE, mix, span_hashes, word_spans

PAGE_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
_WORDS, _BYTES = 0, 1
_END_WORD = np.uint64(0x5851F42D4C957F2D)


def _keys(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word keys and their rows, byte-string keys and their rows; each text is closed by an end.

    A string is its context, the farthest byte first, then the byte behind it.
    """
    n = len(offsets) - 1
    lower = LOWER[data]
    starts, ends, row = word_spans(lower, offsets, NON_SPACE)
    words = np.concatenate([span_hashes(lower, starts, ends), np.full(n, _END_WORD)])
    word_row = np.concatenate([row, np.arange(n)])
    # one zero after each text as its end, and the zeros before the next
    sizes = np.diff(offsets)
    lead = depth
    at = np.concatenate([[0], np.cumsum(sizes + 1 + lead)])
    padded = np.zeros(int(at[-1]), dtype=np.uint8)
    shift = np.repeat(at[:-1] + lead - offsets[:-1], sizes)
    padded[np.arange(len(data)) + shift] = data
    codes = np.zeros(max(len(padded) - depth, 0), dtype=np.uint64)
    for i in range(depth + 1):
        codes = (codes << np.uint64(8)) | padded[i : len(padded) - depth + i]
    byte_row = np.repeat(np.arange(n), sizes + 1)
    first = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(sizes + 1)])[:-1], sizes + 1)
    return words, word_row, codes[np.arange(len(byte_row)) + first], byte_row


def _shard_of(kind: int, keys: np.ndarray, shards: int) -> np.ndarray:
    spread = mix((keys >> np.uint64(8)) & np.uint64(0xFFFF)) if kind == _BYTES else keys
    return (spread % np.uint64(shards)).astype(np.int64)


def _by_shard(kind: int, keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shard and positions (keys ascending) of the distinct sorted ``keys``."""
    shard = _shard_of(kind, keys, shards)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(bounds)):
        yield int(s), order[bounds[s] : bounds[s + 1]]


def _sum_shard(table: pa.Table) -> pa.Table:
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<i8")
    distinct, at = np.unique(keys, return_inverse=True)
    totals = np.bincount(at, weights=counts.astype(np.float64), minlength=len(distinct)).astype("<i8")
    return pa.table(
        {
            "kind": table.column("kind").slice(0, 1),
            "shard": table.column("shard").slice(0, 1),
            "keys": pa.array([distinct.tobytes()], pa.binary()),
            "counts": pa.array([totals.tobytes()], pa.binary()),
            "n_keys": pa.array([len(distinct)], pa.int64()),
            "total": pa.array([int(totals.sum())], pa.int64()),
        }
    )
