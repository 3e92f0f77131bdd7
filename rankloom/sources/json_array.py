"""One JSON array per file, read by many tasks.

A file is cut into byte ranges. Whether a range begins inside a string, and how deep, depends on all
bytes before it, so the ranges are read twice:

1. Each range is scanned on its own: does it hold an odd number of quotes, and how much deeper is its end than its
   start, if it begins outside a string and if it begins inside one. A prefix sum over these few numbers, one row
   per range, gives every range's true start.
2. Knowing its start, a range gives the elements of the array whose separator (the opening bracket or a
   comma at depth one) lies in it, reading on behind its end until the last of them is whole.

Brackets, commas and escaped quotes inside strings therefore never cut a record, and no task holds more than a
piece of the file and one element.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rankloom.sources.files import list_files, open_uri

RANGE_BYTES = 64 << 20
PIECE = 4 << 20
BEHIND = 1 << 14
TASK_BYTES = 16 << 20  # beyond OWN_TASKS small ranges share a task
OWN_TASKS = 1024
BATCH_BYTES = 4 << 20
_QUOTE, _BACKSLASH, _COMMA = b'"\\,'
_SPACE = b" \t\r\n"


class Pieces:
    """The bytes of a file from ``start`` on, piece by piece, with what is known of their quotes and brackets.

    No piece reaches over ``end``; those behind it, asked for until an element is whole, are short.
    """

    def __init__(self, source, start: int, end: int, inside: bool, depth: int):
        self.source, self.at, self.end, self.inside, self.depth = source, start, end, inside, depth
        self.backslashes = _run_before(source, start)

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``position, bytes, inside a string, depth behind each byte``."""
        self.source.seek(self.at)
        while raw := self.source.read(min(PIECE, self.end - self.at) if self.at < self.end else BEHIND):
            b = np.frombuffer(raw, np.uint8)
            place = np.arange(len(b))
            # a quote counts if the run of backslashes before it is even
            other = np.maximum.accumulate(np.where(b != _BACKSLASH, place, -1))
            before = np.concatenate([[-1], other[:-1]])
            run = place - 1 - before + np.where(before < 0, self.backslashes, 0)
            quote = (b == _QUOTE) & (run % 2 == 0)
            within = (np.cumsum(quote) + self.inside) % 2 == 1
            opens, closes = (b == 0x7B) | (b == 0x5B), (b == 0x7D) | (b == 0x5D)
            step = np.where(within, 0, opens.astype(np.int8) - closes.astype(np.int8))
            depth = np.cumsum(step, dtype=np.int64) + self.depth
            yield self.at, b, within, depth
            left = len(b) - 1 - int(other[-1])
            self.backslashes = left + (self.backslashes if left == len(b) else 0)
            self.inside, self.depth, self.at = bool(within[-1]), int(depth[-1]), self.at + len(b)


def _run_before(source, start: int) -> int:
    """Length of the run of backslashes that ends at ``start``."""
    n = 0
    while start > n:
        size = min(4096, start - n)
        source.seek(start - n - size)
        raw = source.read(size)
        kept = len(raw.rstrip(b"\\"))
        n += size - kept
        if kept:
            break
    return n


_SCANS = "path string, start long, odd boolean, deeper_outside long, deeper_inside long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
            store, name = open_uri(path)
            with store.open_input_file(name) as source:
                odd, deeper = False, [0, 0]
                for at, b, within, _ in Pieces(source, start, end, False, 0):
                    n = min(len(b), end - at)
                    b, within = b[:n], within[:n]
                    step = ((b == 0x7B) | (b == 0x5B)).astype(np.int64) - ((b == 0x7D) | (b == 0x5D))
                    deeper[0] += int(step[~within].sum())
                    deeper[1] += int(step[within].sum())
                    odd = bool(within[-1]) if n else odd
                    if at + n >= end:
                        break
            out.append((path, start, odd, *deeper))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()))],
            ["path", "start", "odd", "deeper_outside", "deeper_inside"],
        )


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end, inside, depth in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end", "inside", "depth"))):
            store, name = open_uri(path)
            offsets, texts, held = [], [], 0
            with store.open_input_file(name) as source:
                for offset, raw in _range_elements(source, start, end, inside, depth):
                    offsets.append(offset)
                    texts.append(raw.decode("utf-8"))
                    held += len(raw)
                    if held > BATCH_BYTES:
                        yield _rows(path, offsets, texts)
                        offsets, texts, held = [], [], 0
            yield _rows(path, offsets, texts)


def _rows(path: str, offsets: list[int], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(offsets), pa.string()), pa.array(offsets, pa.int64()), pa.array(texts, pa.string())], ["path", "offset", "value"])


def _range_elements(source, start: int, end: int, inside: bool, depth: int) -> Iterator[tuple[int, bytes]]:
    """``offset, text`` of the elements whose separator lies in ``start … end``."""
    opened, text, first = None, bytearray(), False  # offset behind the separator; bytes so far; behind the bracket
    for at, b, within, after in Pieces(source, start, end, inside, depth):
        before = np.concatenate([[depth], after[:-1]])
        depth = int(after[-1])
        comma = (b == _COMMA) & ~within & (after == 1)
        begins, ends = (before == 0) & (after == 1), (before == 1) & (after == 0)
        last = 0
        for p in np.flatnonzero(comma | begins | ends):
            if opened is not None:
                text += b[last:p].tobytes()
                if text.strip(_SPACE):
                    yield opened, bytes(text.strip(_SPACE))
                elif not (first and ends[p]):
                    raise ValueError(f"an element is missing at byte {at + int(p)}")
            opened = None
            if at + p >= end:
                return
            if not ends[p]:
                opened, text, first, last = at + int(p) + 1, bytearray(), bool(begins[p]), int(p) + 1
        if opened is not None:
            text += b[last:].tobytes()
        elif at + len(b) >= end:
            return


def _starts(scans: list[tuple], sizes: dict[str, int]) -> list[tuple]:
    """``path, start, end, inside, depth`` of every range, by prefix sums over the scans of its file."""
    out, state = [], {}
    for path, start, end, odd, outside, within in scans:
        inside, depth = state.get(path, (False, 0))
        out.append((path, start, end, inside, depth))
        state[path] = (inside != odd, depth + (within if inside else outside))
    for path, (inside, depth) in state.items():
        if inside or depth:
            raise ValueError(f"{path} ends inside a {'string' if inside else 'bracket'}")
    return out


def array_elements(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, offset, value)``: the text of every element of the arrays at ``path``, one array per file.

    The driver sees one row per range. Files that hold no array, end inside one or miss an element are errors.
    """
    files = dict(list_files(spark, path))
    for name in files:
        store, local = open_uri(name)
        with store.open_input_file(local) as source:
            head = source.read(1 << 16).removeprefix(b"\xef\xbb\xbf").lstrip(_SPACE)
        if not head.startswith(b"["):
            raise ValueError(f"{name} doesn't begin with an array")
    ranges = [(name, at, min(at + range_bytes, size)) for name, size in sorted(files.items()) for at in range(0, size, range_bytes)]

    tasks = min(len(ranges), max(OWN_TASKS, -(-sum(files.values()) // TASK_BYTES)))

    def spread(rows: list[tuple], schema: str) -> DataFrame:
        return spark.createDataFrame(rows, schema).repartition(tasks, F.xxhash64("path", "start"))

    scans = {(r["path"], r["start"]): r for r in spread(ranges, "path string, start long, end long").mapInArrow(_scan, _SCANS).collect()}
    ordered = [(p, s, e, *(scans[p, s][c] for c in ("odd", "deeper_outside", "deeper_inside"))) for p, s, e in ranges]
    known = spread(_starts(ordered, files), "path string, start long, end long, inside boolean, depth long")
    return known.mapInArrow(_elements, "path string, offset long, value string")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The elements as rows of ``schema``."""
    parsed = array_elements(spark, path, range_bytes).select(F.from_json("value", schema).alias("r"))
    return parsed.select("r.*")
