"""Token ids in seekable Zstandard files: independent frames, a trailing seek table, checksums.

A file is a run of Zstandard frames, each decodable alone. A frame holds the rows of some documents:

    number of documents u32 | per document: has id u8, id i64, number of ids u32 | all ids u16 or u32

all little-endian. After them come two skippable frames: the document index (first id and number of
documents of each frame, and the width of an id) and the seek table of the seekable Zstandard format
(compressed size, size and XXH64 checksum of each frame, then the number of frames, a descriptor and
the magic number). A reader takes the seek table from the end of the file and decompresses only the
frames whose documents are asked for.

Documents are written in ascending id (null first): ranges of ids with about equal bytes are
shards, a shard is one file written by one task as a stream. Attempts write under a name of their own
and rename, so a lost or repeated task leaves one whole file.

Null and empty texts give documents with the end id alone. Repeated ids keep their rows, in an order
that is fixed by the text. An empty table gives no files. Extra columns are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from rankloom.llm.kernels import NON_SPACE, blobs, give_back, span_hashes, text_slices, word_spans
from rankloom.llm.shared_files import open_folder, qualified
from rankloom.llm.tables import doc_rows, stored

FRAME_BYTES = 1 << 20
SHARD_BYTES = 64 << 20
_SEEK_MAGIC, _INDEX_MAGIC, _FOOTER_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
_CACHE = 800_000
_SLICE = 4 << 20
_TOGETHER = 500  # parts in one call of the library

_tokenizers: dict[str, Tokenizer] = {}
_encoders: dict[str, "WordEncoder"] = {}  # a worker process keeps what its tasks have learned


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file as the library loads it, once per worker process."""
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _places(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions ``at[i] … at[i] + sizes[i] - 1`` of all runs one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - sizes), sizes)


class WordEncoder:
    """Ids of whole texts from the ids of their white-space separated parts, which are kept.

    Only for tokenizers that drop white space and never join across it. The parts kept are a sorted
    array of hashes with places in one array of ids; beyond ``_CACHE`` of them the half that was in
    the most slices stays.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.words = np.zeros(0, np.uint64)
        self.at, self.sizes, self.seen = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)

    def _find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        place = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return place, self.words[place] == words

    def _forget(self) -> None:
        keep = np.sort(np.argpartition(-self.seen, _CACHE // 2)[: _CACHE // 2])
        self.ids = self.ids[_places(self.at[keep], self.sizes[keep])]
        self.words, self.sizes, self.seen = self.words[keep], self.sizes[keep], self.seen[keep] >> 1
        self.at = np.cumsum(self.sizes) - self.sizes

    def _encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts, and the number of ids of each.

        Many parts are one text for the library, as a text of its own costs it more than the part; where an id
        starts in that text tells whose it is.
        """
        runs = [parts[i : i + _TOGETHER] for i in range(0, len(parts), _TOGETHER)]
        ids, sizes = [], []
        for run, e in zip(runs, self.tokenizer.encode_batch([" ".join(run) for run in runs], add_special_tokens=False)):
            lengths = np.fromiter(map(len, run), np.int64, len(run)) + 1
            at = np.fromiter(map(itemgetter(0), e.offsets), np.int64, len(e))
            ids.append(np.fromiter(e.ids, np.uint32, len(e)))
            sizes.append(np.bincount(np.searchsorted(np.cumsum(lengths), at, side="right"), minlength=len(run)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, words: np.ndarray, parts: list[str]) -> None:
        ids, sizes = self._encoded(parts)
        at = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        merged = np.concatenate([self.words, words])
        order = np.argsort(merged, kind="stable")
        self.words = merged[order]
        self.at, self.sizes = np.concatenate([self.at, at])[order], np.concatenate([self.sizes, sizes])[order]
        self.seen = np.concatenate([self.seen, np.zeros(len(words), np.int64)])[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and the number of ids of each row."""
        starts, ends, row = word_spans(data, offsets, NON_SPACE)
        words, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.words) > _CACHE:
            self._forget()
        new = np.flatnonzero(~self._find(words)[1])
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(words[new], [raw[lo:hi].decode("utf-8", "replace") for lo, hi in spans])
        place = self._find(words)[0]
        if len(place):
            self.seen[place] += 1
        each = place[inverse]
        counts = self.sizes[each]
        per_row = np.bincount(row, weights=counts, minlength=len(offsets) - 1).astype(np.int64)
        return self.ids[_places(self.at[each], counts)], per_row


def _encode(path: str, end_id: int, width: int, edges: np.ndarray):
    """Ids of each row, and its shard: the number of ``edges`` at or below its id, null being below all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = WordEncoder(path)
        encoder = _encoders[path]
        for part, data, offsets in text_slices(batches, "text", _SLICE):
            ids, counts = encoder.encode(data, offsets)
            closed = np.insert(ids, np.cumsum(counts), end_id).astype(f"<u{width}")
            ends = np.concatenate([[0], np.cumsum(counts + 1)])
            ids_of = part.column("doc_id")
            known = ids_of.is_valid().to_numpy(zero_copy_only=False)
            shard = np.where(known, np.searchsorted(edges, ids_of.fill_null(0).to_numpy(zero_copy_only=False), side="right"), 0)
            columns = [pa.array(shard.astype(np.int32)), ids_of, part.column("tie"), blobs(closed.tobytes(), ends * width)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "tie", "ids"])

    return run


def _skippable(magic: int, payload: bytes) -> bytes:
    return struct.pack("<II", magic, len(payload)) + payload


class FrameWriter:
    """Appends documents to an open file; ``close`` writes the index and the seek table."""

    def __init__(self, out, width: int, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.width, self.limit = out, width, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, bytes]] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, ids))
        self.held += len(ids) + 13
        if self.held >= self.limit:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        head = b"".join(struct.pack("<BqI", d is not None, d or 0, len(x) // self.width) for d, x in self.docs)
        raw = struct.pack("<I", len(self.docs)) + head + b"".join(x for _, x in self.docs)
        frame = self.compressor.compress(raw)
        self.out.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        first = self.docs[0][0]
        self.index.append((first is not None, first or 0, len(self.docs)))
        self.docs, self.held = [], 0

    def close(self) -> None:
        self.flush()
        body = struct.pack("<BI", self.width, len(self.index)) + b"".join(struct.pack("<BqI", *x) for x in self.index)
        self.out.write(_skippable(_INDEX_MAGIC, body))
        table = b"".join(struct.pack("<III", *x) for x in self.entries)
        footer = struct.pack("<IBI", len(self.entries), 0x80, _FOOTER_MAGIC)
        self.out.write(_skippable(_SEEK_MAGIC, table + footer))


class FrameReader:
    """Reads the seek table and the index of an open file, then frames on request."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _FOOTER_MAGIC or not descriptor & 0x80:
            raise ValueError("no seek table at the end of the file")
        table = self._at(size - 9 - 12 * n, 12 * n)
        self.entries = list(struct.iter_unpack("<III", table))
        self.offsets = np.concatenate([[0], np.cumsum([e[0] for e in self.entries])]).astype(np.int64)
        index_at = int(self.offsets[-1])
        magic, length = struct.unpack("<II", self._at(index_at, 8))
        if magic != _INDEX_MAGIC:
            raise ValueError("no document index before the seek table")
        body = self._at(index_at + 8, length)
        self.width, _ = struct.unpack_from("<BI", body)
        self.index = [(d if has else None, k) for has, d, k in struct.iter_unpack("<BqI", body[5:])]

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, i: int) -> list[tuple[int | None, np.ndarray]]:
        """Documents of frame ``i``; a damaged frame is an error."""
        packed, size, checksum = self.entries[i]
        raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[i]), packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} fails its checksum")
        (n,) = struct.unpack_from("<I", raw)
        heads = list(struct.iter_unpack("<BqI", raw[4 : 4 + 13 * n]))
        out, at = [], 4 + 13 * n
        for has, doc_id, k in heads:
            out.append((doc_id if has else None, np.frombuffer(raw, f"<u{self.width}", k, at)))
            at += k * self.width
        return out

    def documents(self, wanted: list[int]) -> list[tuple[int, np.ndarray]]:
        """The wanted documents, from the frames that can hold them only."""
        firsts = [-(1 << 63) if d is None else d for d, _ in self.index]
        frames = set()
        for doc_id in wanted:
            hi = int(np.searchsorted(firsts, doc_id, side="right"))
            lo = int(np.searchsorted(firsts, doc_id, side="left"))
            frames.update(range(max(lo - 1, 0), hi))
        keep = set(wanted)
        return [(d, ids) for i in sorted(frames) for d, ids in self.frame(i) if d in keep]


def _write(folder: str, width: int, frame_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        writer, shard, temporary, docs, ids = None, None, "", 0, 0

        def close() -> pa.RecordBatch:
            writer.close()
            writer.out.close()
            name = f"part-{shard:06d}.zst"
            store.move(temporary, f"{base}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([docs], pa.int64()), pa.array([ids], pa.int64())], ["shard", "path", "n_docs", "n_ids"])

        for batch in batches:
            for s, d, raw in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                if s != shard:
                    if writer is not None:
                        yield close()
                    shard, docs, ids = s, 0, 0
                    temporary = f"{base}/.part-{s:06d}.{uuid.uuid4().hex}"
                    writer = FrameWriter(store.open_output_stream(temporary), width, frame_bytes)
                writer.add(d, raw)
                docs += 1
                ids += len(raw) // width
        if writer is not None:
            yield close()
        give_back()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, *, end_id: int, shard_bytes: int = SHARD_BYTES, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the ids of every document below ``folder``; ``shard, path, n_docs, n_ids, base`` of each file.

    ``base`` is the number of ids in the files before it.
    """
    rows = doc_rows(docs)
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    shards = int(total // shard_bytes) + 1
    # bounds that cut the bytes about evenly; how even they are doesn't change the result
    edges: list[int] = []
    if shards > 1:
        accuracy = max(10_000, 20 * shards)  # so that bounds stay apart however many shards there are
        edges = sorted(set(rows.select(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)], F.lit(accuracy)).alias("q")).first()["q"] or []))
    width = 2 if tokenizer(tokenizer_path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    folder = qualified(docs.sparkSession, folder)
    store, base = open_folder(folder)
    store.create_dir(base)
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    ids = keyed.mapInArrow(_encode(tokenizer_path, end_id, width, np.array(edges, np.int64)), "shard int, doc_id long, tie long, ids binary")
    # a shard is a partition of its own
    spread = ids.repartitionById(len(edges) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "tie")
    files = stored(spread.mapInArrow(_write(folder, width, frame_bytes), "shard int, path string, n_docs long, n_ids long"), "token_files")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of ``files`` (``path, base``), checksums verified.

    ``wanted``: only these documents, from the frames that hold them; ``start`` is then null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                store, name = open_folder(path)
                with store.open_input_file(name) as source:
                    reader = FrameReader(source)
                    if wanted is not None:
                        yield _read_batch([(d, None, x) for d, x in reader.documents(wanted)])
                        continue
                    for i in range(len(reader.entries)):
                        rows = []
                        for d, x in reader.frame(i):
                            rows.append((d, base, x))
                            base += len(x)
                        yield _read_batch(rows)

    spread = files.select("path", "base").repartition(max(1, min(files.count(), 10_000)), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _, _ in rows], pa.int64()),
            pa.array([s for _, s, _ in rows], pa.int64()),
            pa.array([len(x) for _, _, x in rows], pa.int64()),
            pa.array([x.astype("<u4").tobytes() for _, _, x in rows], pa.binary()),
        ],
        ["doc_id", "start", "n_tokens", "ids"],
    )
