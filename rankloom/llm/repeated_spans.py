"""Removal of byte strings that already start in an earlier document, by minimisers.

Every byte covered by a ``length``-byte string that also starts in a document with a smaller id goes.
Prefix doubling would sort a pair of ranks for every position, round after round; the README says what its first
round costs here. Instead only minimisers enter: of each ``length``-byte window the right-most
smallest hash of its ``gram``-byte strings. The choice depends on the window's bytes alone, so equal
windows choose the same place, and one in about ``(length - gram) / 2`` positions is enough.

1. Rank by ``gram`` bytes: positions with the same string meet in one shard.
2. Rank by the longer string that spans all windows of the position (up to ``2 length - gram`` bytes):
   all but the smallest document of a rank are settled, every window of theirs is repeated.
3. Where one ``gram``-byte string is left with several longer ones (the edges of repeats), their windows
   are ranked by all ``length`` bytes, one representative document per rank of step 2.

Ranks are hashes (of a gram 40 bits travel besides its shard, of a rank 48), so naming needs no global sort.
Positions travel packed, a block per slice of
text and shard; within a slice only the smallest document of a rank is sent, so a string that a third of
all documents hold arrives once per slice. Texts longer than a slice are read in parts; windows cut by
that are settled in step 3.

Null and empty texts, and texts shorter than ``length``, lose nothing. Rows with a null id lose nothing
and give nothing. Rows that repeat an id (with the same or another text) don't count as smaller than each
other. Strings never cross documents. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.kernels import _BASE, _BYTE_VALUE, _INVERSE, blobs, give_back, mix, powers, ragged, text_slices
from rankloom.llm.tables import doc_rows, join_by, stored

LENGTH = 50
GRAM = 24
SHARD_BYTES = 8 << 20
_PART = 1 << 20
# of a gram's hash 40 bits travel besides its shard: it only brings positions together; of a rank's, 48
_RECORD = np.dtype(
    [("gram4", "<u4"), ("gram1", "u1"), ("rank4", "<u4"), ("rank2", "<u2"), ("doc", "<i8"), ("tag", "<u4"), ("pos", "<u4"), ("left", "u1"), ("right", "u1")]
)
_FIELDS = ("gram", "rank", "doc", "tag", "pos", "left", "right")
_SPAN = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("stop", "<u4")])
_EDGE = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("pos", "<u4"), ("left", "u1"), ("right", "u1")])
_PLACE = np.dtype([("pos", "<u4"), ("left", "u1"), ("right", "u1")])
_RANGE = np.dtype([("start", "<u4"), ("stop", "<u4")])
_PLACES = {"pos", "start", "stop"}
_WINDOW = np.dtype([("rank", "<u8"), ("doc", "<i8"), ("tag", "<u4"), ("pos", "<u4")])


def pack(records: dict[str, np.ndarray], kind: np.dtype, at: np.ndarray | slice) -> bytes:
    """Columns one after the other, places as differences, compressed: runs of a document cost little."""
    columns = [np.ascontiguousarray(records[k][at], dtype=kind[k]) for k in kind.names]
    raw = [np.diff(c, prepend=c.dtype.type(0)) if k in _PLACES else c for k, c in zip(kind.names, columns)]
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(b"".join(c.tobytes() for c in raw))


def unpack(packed: list[bytes], kind: np.dtype) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {k: [] for k in kind.names}
    plain = zstandard.ZstdDecompressor()
    for one in packed:
        raw = plain.decompress(one)
        n, at = len(raw) // kind.itemsize, 0
        for k in kind.names:
            column = np.frombuffer(raw, kind[k], n, at)
            parts[k].append(np.cumsum(column, dtype=kind[k]) if k in _PLACES else column)
            at += n * kind[k].itemsize
    return {k: np.concatenate(v) if v else np.zeros(0, kind[k]) for k, v in parts.items()}


def _split(records: dict[str, np.ndarray], kind: np.dtype, shard: np.ndarray, shards: int) -> list[tuple[int, bytes]]:
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    return [(int(s), pack(records, kind, order[bounds[s] : bounds[s + 1]])) for s in np.flatnonzero(np.diff(bounds))]


def _doc_shard(doc: np.ndarray, shards: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(shards)).astype(np.int64)


def minimisers(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray] | None:
    """Chosen positions: row, place in the slice, first and last window, hashes of gram and spanned string."""
    n = len(data)
    if n < length:
        return None
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers(_BASE, n), out=sums[1:])
    inverse = powers(_INVERSE, n + 1)
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    width = length - gram + 1
    value, place, have = grams, np.arange(len(grams), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        left, right = value[: len(value) - step], value[step:]
        later = right <= left
        place = np.where(later, place[step:], place[: len(place) - step])
        value = np.where(later, right, left)
        have += step
    # windows that lie in one row
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    if not len(rows):
        return None
    starts = np.arange(len(rows)) + np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    chosen = place[starts]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    p, lo, hi = chosen[first].astype(np.int64), starts[first], starts[last]
    span = (sums[hi + length] - sums[lo]) * inverse[lo]
    rank = mix(span + ((p - lo) * 64 + (p - hi)).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return {"row": rows[first], "at": p, "gram": grams[p], "rank": rank, "left": p - lo, "right": p - hi}


def _parts(batches: Iterator[pa.RecordBatch], length: int):
    """Slices; a row longer than ``_PART`` comes in parts that together hold all its windows."""
    for part, data, offsets in text_slices(batches, "text", _PART):
        if part.num_rows > 1 or len(data) <= 2 * _PART:
            yield part, data, offsets, 0
            continue
        for lo in range(0, len(data) - length + 1, _PART):
            piece = data[lo : lo + _PART + length - 1]
            yield part, piece, np.array([0, len(piece)], dtype=np.int64), lo


def _survey(length: int, gram: int, shards: int, doc_shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets, origin in _parts(batches, length):
            found = minimisers(data, offsets, length, gram)
            if found is None:
                continue
            row = found["row"]
            found["doc"] = part.column("doc_id").to_numpy()[row]
            found["tag"] = part.column("tag").to_numpy()[row].astype(np.uint32)
            found["pos"] = found["at"] - offsets[:-1][row] + origin
            # only the smallest document of a rank goes on; later ones in this slice are settled
            order = np.lexsort((found["doc"], found["rank"], found["gram"]))
            g, r, d = (found[k][order] for k in ("gram", "rank", "doc"))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
            lowest = d[np.flatnonzero(new)][np.cumsum(new) - 1]
            settled = np.zeros(len(order), dtype=bool)
            settled[order] = d > lowest
            live = {k: found[k][~settled] for k in _FIELDS}
            shard = (live["gram"] % np.uint64(shards)).astype(np.int64)
            live |= {"gram4": live["gram"] >> np.uint64(32), "gram1": (live["gram"] >> np.uint64(24)) & np.uint64(255)}
            live |= {"rank4": live["rank"] >> np.uint64(32), "rank2": (live["rank"] >> np.uint64(16)) & np.uint64(0xFFFF)}
            rows = [(0, s, raw) for s, raw in _split(live, _RECORD, shard, shards)]
            rows += [(1, s, raw) for s, raw in _spans({k: found[k][settled] for k in _FIELDS}, length, doc_shards)]
            yield _rows(rows)

    return run


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds, shards, packed = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(shards, pa.int32()), pa.array(packed, pa.binary())], ["kind", "shard", "packed"])


def _spans(records: dict[str, np.ndarray], length: int, doc_shards: int) -> list[tuple[int, bytes]]:
    """All windows of each record as one span."""
    start = records["pos"].astype(np.int64) - records["left"]
    stop = records["pos"].astype(np.int64) - records["right"] + length
    spans = {"doc": records["doc"], "tag": records["tag"], "start": start, "stop": stop}
    return _split(spans, _SPAN, _doc_shard(spans["doc"], doc_shards), doc_shards)


def _settle(length: int, doc_shards: int):
    """One shard: spans of repeated records (kind 1), and records whose windows must be compared (kind 2)."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() == 1:  # settled where they were read
            return table.select(["kind", "shard", "packed"])
        all_ = unpack(table.column("packed").to_pylist(), _RECORD)
        all_["gram"] = (all_.pop("gram4").astype(np.uint64) << np.uint64(8)) | all_.pop("gram1")
        all_["rank"] = (all_.pop("rank4").astype(np.uint64) << np.uint64(16)) | all_.pop("rank2")
        order = np.lexsort((all_["doc"], all_["rank"], all_["gram"]))
        rec = {k: v[order] for k, v in all_.items()}
        g, r, d = rec["gram"], rec["rank"], rec["doc"]
        new_gram = np.ones(len(g), dtype=bool)
        new_gram[1:] = g[1:] != g[:-1]
        new = new_gram.copy()
        new[1:] |= r[1:] != r[:-1]
        lowest = d[np.flatnonzero(new)][np.cumsum(new) - 1]
        repeated = d > lowest
        rows = [(1, s, raw) for s, raw in _spans({k: v[repeated] for k, v in rec.items()}, length, doc_shards)]
        # gram strings left with several ranks in different documents
        at = np.cumsum(new_gram) - 1
        firsts = np.flatnonzero(new_gram)
        ranks = np.add.reduceat(new.astype(np.int64), firsts) if len(firsts) else np.zeros(0, np.int64)
        low = np.minimum.reduceat(lowest, firsts) if len(firsts) else lowest
        high = np.maximum.reduceat(lowest, firsts) if len(firsts) else lowest
        open_ = ((ranks > 1) & (low < high))[at] & ~repeated
        edges = {k: rec[k][open_] for k in _EDGE.names}
        rows += [(2, s, raw) for s, raw in _split(edges, _EDGE, _doc_shard(edges["doc"], doc_shards), doc_shards)]
        return pa.Table.from_batches([_rows(rows)])

    return run


def _edges_by_doc(table: pa.Table) -> pa.Table:
    """Packed edge records of each document."""
    rec = unpack(table.column("packed").to_pylist(), _EDGE)
    order = np.lexsort((rec["pos"], rec["tag"], rec["doc"]))
    rec = {k: v[order] for k, v in rec.items()}
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rec["doc"][1:] != rec["doc"][:-1]) | (rec["tag"][1:] != rec["tag"][:-1])
    first = np.flatnonzero(new)
    bounds = np.append(first, len(order))
    packed = [pack(rec, _PLACE, slice(lo, hi)) for lo, hi in zip(bounds[:-1], bounds[1:])]
    return pa.table({"doc_id": rec["doc"][first], "tag": rec["tag"][first].astype(np.int64), "edges": pa.array(packed, pa.binary())})


def _windows(length: int, shards: int):
    """Rank by all bytes of each window of the edge records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = powers(_BASE, length)
        for batch in batches:
            for part, data, offsets in text_slices(iter([batch]), "text", _PART):
                ranks, docs, tags, places = [], [], [], []
                for i, packed in enumerate(part.column("edges").to_pylist()):
                    e = unpack([packed], _PLACE)
                    n = e["left"].astype(np.int64) - e["right"] + 1
                    first = e["pos"].astype(np.int64) - e["left"]
                    at = np.arange(int(n.sum())) + np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
                    at = np.unique(at)
                    text = data[offsets[i] : offsets[i + 1]]
                    for lo in range(0, len(at), 20_000):
                        window = _BYTE_VALUE[text[at[lo : lo + 20_000, None] + np.arange(length)]]
                        ranks.append(mix((window * weights).sum(axis=1, dtype=np.uint64)))
                    docs.append(np.full(len(at), part.column("doc_id")[i].as_py(), np.int64))
                    tags.append(np.full(len(at), part.column("tag")[i].as_py(), np.int64))
                    places.append(at)
                rec = {k: np.concatenate(v) for k, v in zip(_WINDOW.names, (ranks, docs, tags, places))}
                yield _rows([(3, s, raw) for s, raw in _split(rec, _WINDOW, (rec["rank"] % np.uint64(shards)).astype(np.int64), shards)])

    return run


def _settle_windows(length: int, doc_shards: int):
    def run(table: pa.Table) -> pa.Table:
        all_ = unpack(table.column("packed").to_pylist(), _WINDOW)
        order = np.lexsort((all_["doc"], all_["rank"]))
        rec = {k: v[order] for k, v in all_.items()}
        new = np.ones(len(order), dtype=bool)
        new[1:] = rec["rank"][1:] != rec["rank"][:-1]
        repeated = rec["doc"] > rec["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
        start = rec["pos"][repeated].astype(np.int64)
        spans = {"doc": rec["doc"][repeated], "tag": rec["tag"][repeated], "start": start, "stop": start + length}
        return pa.Table.from_batches([_rows([(1, s, raw) for s, raw in _split(spans, _SPAN, _doc_shard(spans["doc"], doc_shards), doc_shards)])])

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Disjoint spans of each document of a shard."""
    rec = unpack(table.column("packed").to_pylist(), _SPAN)
    order = np.lexsort((rec["start"], rec["tag"], rec["doc"]))
    doc, tag, start, stop = (rec[k][order].astype(np.int64) for k in _SPAN.names)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    # ends so far within the document: a running maximum over keys that rise with the document
    base = np.cumsum(new) << 33
    reach = np.maximum.accumulate(base + stop)
    gap = new.copy()
    gap[1:] |= (base + start)[1:] > reach[:-1]
    first = np.flatnonzero(gap)
    ends = (reach - base)[np.append(first[1:], len(doc)) - 1]
    docs = np.flatnonzero(new[first])
    counts = np.diff(np.append(docs, len(first)))
    found = {"start": start[first], "stop": ends}
    bounds = np.append(docs, len(first))
    packed = [pack(found, _RANGE, slice(lo, hi)) for lo, hi in zip(bounds[:-1], bounds[1:])]
    return pa.table({"doc_id": doc[first][docs], "tag": tag[first][docs], "spans": pa.array(packed, pa.binary())})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in text_slices(batches, "text"):
        removed = np.zeros(part.num_rows, dtype=np.int64)
        spans = np.zeros(part.num_rows, dtype=np.int64)
        kept = np.ones(len(data), dtype=bool)
        found = [unpack([x] if x else [], _RANGE) for x in part.column("spans").to_pylist()]
        for i, ranges in enumerate(found):
            for lo, hi in zip(ranges["start"].tolist(), ranges["stop"].tolist()):
                kept[offsets[i] + lo : offsets[i] + hi] = False
                removed[i] += hi - lo
            spans[i] = len(ranges["start"])
        left = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), blobs(data[kept].tobytes(), left)]
            + [ragged(np.concatenate([x[k] for x in found]).astype(np.int32), spans, pa.int32()) for k in ("start", "stop")],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "starts", "stops"],
        )


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, starts, stops`` of every row; ``kept`` are the bytes left."""
    if not 8 <= gram < length <= 250:
        raise ValueError("need 8 <= gram < length <= 250")
    rows = doc_rows(docs).withColumn("tag", F.xxhash64("text").bitwiseAND(0xFFFFFFFF))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    shards = int(total // shard_bytes) + 8
    named = rows.where("doc_id IS NOT NULL")
    kinds = "kind int, shard int, packed binary"
    survey = named.mapInArrow(_survey(length, gram, shards, shards), kinds)
    settled = stored(survey.groupBy("kind", "shard").applyInArrow(_settle(length, shards), kinds), "repeats_settled")
    edges = settled.where("kind = 2").groupBy("shard").applyInArrow(_edges_by_doc, "doc_id long, tag long, edges binary")
    edges = stored(edges, "repeats_edges")
    windows = join_by(named, edges, ["doc_id", "tag"], "inner").mapInArrow(_windows(length, shards), kinds)
    compared = windows.groupBy("shard").applyInArrow(_settle_windows(length, shards), kinds)
    spans = settled.where("kind = 1").unionByName(compared)
    merged = stored(spans.groupBy("shard").applyInArrow(_merge, "doc_id long, tag long, spans binary"), "repeats_merged")
    return join_by(rows, merged, ["doc_id", "tag"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, starts array<int>, stops array<int>"
    )
