"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts of at most ``chunk`` code points are encoded where they lie. Longer ones are cut into
chunks that overlap by ``overlap`` code points; the chunks are spread over the cluster and
pre-tokenised independently of each other. The matches of the pattern depend only on where the
previous match ended, so two neighbours agree from the first boundary they share; the text is
cut there and every piece between two cuts is encoded on its own. Decoding concatenates the
bytes of the ids.

Null and empty texts give no ids. Rows are encoded one by one: repeated ids, null ids and
repeated texts each keep their row; long rows that repeat both are encoded once and counted. Extra
columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rankloom.llm.kernels import blobs
from rankloom.llm.tables import doc_rows, join_by, stored

CHUNK = 16_384
OVERLAP = 512

_loaded: dict[tuple[str, str], tiktoken.Encoding] = {}
_bytes: dict[str, pa.Array] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file, loaded once per worker process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _loaded[path, pattern]


def token_bytes(path: str) -> pa.Array:
    """Bytes of every id, in order of the ids."""
    if path not in _bytes:
        ranks = read_ranks(path)
        by_id: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        _bytes[path] = pa.array(by_id, type=pa.large_binary())
    return _bytes[path]


def _ids_column(texts: list[str], enc: tiktoken.Encoding) -> tuple[pa.Array, np.ndarray]:
    parts = [np.asarray(enc.encode_ordinary(t), dtype="<u4") for t in texts]
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    offsets = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum(counts * 4, out=offsets[1:])
    return blobs(np.concatenate(parts).tobytes() if parts else b"", offsets), counts


def _groups(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, size):
        yield batch.slice(lo, size)


def _encode_rows(path: str, pattern: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            for part in _groups(batch):
                ids, counts = _ids_column(part.column("text").to_pylist(), enc)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(counts), ids], [*keep, "n_tokens", "ids"])

    return run


def _cut_chunks(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch, 16):
                for doc, key, text in zip(part.column("doc_id"), part.column("key"), part.column("text")):
                    whole = text.as_py()
                    n = -(-len(whole) // chunk)
                    for lo in range(0, n, 64):
                        which = list(range(lo, min(n, lo + 64)))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([doc.as_py()] * len(which), pa.int64()),
                                pa.array([key.as_py()] * len(which), pa.int64()),
                                pa.array(which, pa.int32()),
                                pa.array([n] * len(which), pa.int32()),
                                pa.array([whole[c * chunk : (c + 1) * chunk + overlap] for c in which]),
                            ],
                            ["doc_id", "key", "chunk_no", "n_chunks", "text"],
                        )

    return run


def chunk_boundaries(text: str, pattern: regex.Pattern, chunk: int, overlap: int, last: bool) -> tuple[list[int], list[int]]:
    """Places where the chunk may be cut: in its first ``overlap`` code points, and in the last.

    A match that reaches the chunk's end could be longer in the whole text, and one before white
    space looks one code point ahead; both are left out, so what is returned holds in the whole
    text as soon as one earlier boundary does.
    """
    left, right = [], []
    stop = len(text) if last else len(text) - 1
    for m in pattern.finditer(text):
        end = m.end()
        if end >= stop:
            break
        if text[end - 1].isspace():
            continue
        if end < overlap:
            left.append(end)
        elif end >= chunk:
            right.append(end - chunk)
    return left, right


def _pre_tokenise(pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            for part in _groups(batch, 64):
                found = [
                    chunk_boundaries(t, compiled, chunk, overlap, c + 1 == n)
                    for t, c, n in zip(part.column("text").to_pylist(), part.column("chunk_no").to_pylist(), part.column("n_chunks").to_pylist())
                ]
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x for x, _ in found], kind), pa.array([x for _, x in found], kind)],
                    [*part.schema.names, "left", "right"],
                )

    return run


def _join_pieces(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("chunk_no").to_numpy())
    parts = table.column("ids").to_pylist()
    return pa.table(
        {
            "doc_id": table.column("doc_id").slice(0, 1),
            "key": table.column("key").slice(0, 1),
            "n_tokens": pa.array([sum(table.column("n_tokens").to_pylist())], pa.int64()),
            "ids": pa.array([b"".join(parts[i] for i in order)], pa.binary()),
        }
    )


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit), equal to encoding each whole text.

    A text whose neighbouring chunks share no boundary in some overlap (a run of one kind of
    character longer than that) is encoded whole, as one row.
    """
    if not 2 * overlap <= chunk:
        raise ValueError("chunks must be at least two overlaps long")
    rows = doc_rows(docs)
    size = F.char_length("text")
    short = rows.where(size <= chunk).mapInArrow(_encode_rows(ranks_path, pattern, ["doc_id"]), "doc_id long, n_tokens long, ids binary")
    long = rows.where(size > chunk).withColumn("key", F.xxhash64("doc_id", "text"))
    chunks = (
        long.dropDuplicates(["doc_id", "key"])
        .mapInArrow(_cut_chunks(chunk, overlap), "doc_id long, key long, chunk_no int, n_chunks int, text string")
        .repartition("key", "chunk_no")
        .mapInArrow(
            _pre_tokenise(pattern, chunk, overlap),
            "doc_id long, key long, chunk_no int, n_chunks int, text string, left array<int>, right array<int>",
        )
    )
    chunks = stored(chunks, "bpe_chunks")
    ordered = Window.partitionBy("doc_id", "key").orderBy("chunk_no")
    # cut at the first boundary both neighbours found; -1 where there is none
    cuts = (
        chunks.select("doc_id", "key", "chunk_no", "n_chunks", "right", F.lead("left").over(ordered).alias("_next"))
        .withColumn("_cut", F.coalesce(F.array_min(F.array_intersect("right", "_next")), F.lit(-1)))
        .withColumn("stop", F.when(F.col("chunk_no") + 1 == F.col("n_chunks"), F.lit(None).cast("int")).otherwise(F.col("_cut") + chunk))
        .withColumn("start", F.coalesce(F.lag("_cut").over(ordered), F.lit(0)))
        .withColumn("_bad", F.when((F.col("_cut") < 0) & (F.col("chunk_no") + 1 < F.col("n_chunks")), 1).otherwise(0))
    )
    cuts = stored(cuts.select("doc_id", "key", "chunk_no", "start", "stop", "_bad"), "bpe_cuts")
    whole = cuts.where("_bad = 1").select("doc_id", "key").distinct()
    pieces = join_by(join_by(chunks.drop("left", "right"), whole, ["doc_id", "key"], "left_anti"), cuts, ["doc_id", "key", "chunk_no"], "inner")
    pieces = pieces.select(
        "doc_id", "key", "chunk_no", F.expr("substring(text, start + 1, coalesce(stop, char_length(text)) - start)").alias("text")
    )
    joined = (
        pieces.mapInArrow(_encode_rows(ranks_path, pattern, ["doc_id", "key", "chunk_no"]), "doc_id long, key long, chunk_no int, n_tokens long, ids binary")
        .groupBy("doc_id", "key")
        .applyInArrow(_join_pieces, "doc_id long, key long, n_tokens long, ids binary")
    )
    rest = (
        join_by(long, whole, ["doc_id", "key"], "left_semi")
        .dropDuplicates(["doc_id", "key"])
        .mapInArrow(_encode_rows(ranks_path, pattern, ["doc_id", "key"]), "doc_id long, key long, n_tokens long, ids binary")
    )
    # rows that repeat id and text were encoded once and come back as often as they were
    repeats = stored(long.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1"), "bpe_repeats")
    counted = join_by(joined.unionByName(rest), repeats, ["doc_id", "key"], "left")
    each = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_times", F.lit(1).cast("long")))))
    return short.unionByName(each.select("doc_id", "n_tokens", "ids"))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes of each row's ids, one after the other."""
    columns = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = token_bytes(ranks_path)
        for batch in batches:
            for part in _groups(batch):
                raw = part.column("ids").fill_null(b"").to_pylist()
                ids = np.frombuffer(b"".join(raw), dtype="<u4")
                taken = vocabulary.take(pa.array(ids))
                _, at, data = taken.buffers()
                at = np.frombuffer(at, dtype=np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])]).astype(np.int64)
                decoded = blobs(data if data is not None else b"", at[ends])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], [*columns, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))
