"""Language-model scores by context-tree weighting, and a unigram base score.

Every byte of a text (and an end byte 0) is eight binary decisions; each is predicted in the tree of
the ``depth`` bytes before it (zeros before the start). Per node the training bytes give counts a, b
and the Krichevsky-Trofimov estimate; bottom-up, ``P_w = (P_KT + product of the children's P_w) / 2``
weighs stopping at a node against going on. A byte's probability mixes the estimates of all depths
with these weights; a context never seen in training leaves the rest to the last one seen.

A byte string is a number: the context, its nearest byte first, then the byte that is scored. In the order of
these numbers the strings of any context stand together at every depth, so the nodes of a tree are runs.

Nothing of the model is held whole anywhere. Training counts of byte strings and of words are packed
per slice of text, summed by key range and kept as shards. Texts are grouped into pages of bounded
size; a page asks the shards for its distinct strings and words, and the answers go back to the page.
Only the nodes of depth 0 and 1 (at most 256 * 255 + 255) are sent to all tasks. Sorted keys travel as
differences, all numbers by byte plane and compressed, and scores to 36 binary digits (1.5e-11).

The base score is the sum over words (and one end per text) of log10((c + 0.5) / (N + 0.5 (V + 1))).

Null and empty texts consist of their end. Rows are scored one by one: repeated rows and ids each
keep theirs, null ids train. Without training text all bytes have probability 1/256. Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.byte_strings import _BYTES, _END_WORD, _WORDS, SHARD_BYTES
from rankloom.llm.kernels import LOWER, NON_SPACE, give_back, mix, span_hashes, text_buffer, text_slices, word_spans
from rankloom.llm.tables import doc_rows, stored

DEPTH = 6  # 7 is the deepest that fits a 64-bit key with the byte after it
PAGE_BYTES = 6 << 20
GROUP_KEYS = 250_000
SCORE_KEYS = 100_000
SCORE_PLANES = 6  # of the eight bytes of a score the first six travel


# --- numbers on their way -------------------------------------------------------------------------


def packed_numbers(values: np.ndarray, planes: int = 8) -> bytes:
    """Eight-byte numbers by byte plane, the highest first and only so many, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(raw.T[::-1][:planes].tobytes())


def unpacked_numbers(raw: bytes, dtype: type, planes: int = 8) -> np.ndarray:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(planes, -1)
    out = np.zeros((plain.shape[1], 8), np.uint8)
    out[:, 8 - planes :] = plain[::-1].T
    return out.view(dtype).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences."""
    return packed_numbers(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked_numbers(raw, np.uint64), dtype=np.uint64)


def strings(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of every byte and of the end of each text, and its row."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    # zeros before each text as its first contexts, one behind it as its end
    at = np.concatenate([[0], np.cumsum(sizes + depth + 1)])
    text = np.ones(int(at[-1]), dtype=bool)
    text[(at[:-1, None] + np.arange(depth)[None, :]).ravel()] = text[at[1:] - 1] = False
    padded = np.zeros(int(at[-1]) + 8, dtype=np.uint8)
    padded[:-8][text] = data
    # windows of depth + 1 bytes: all that end on a text's byte or end
    scored = text
    scored[at[1:] - 1] = True
    starts = np.ndarray((len(padded) - 8,), "<u8", padded, strides=(1,))[: max(len(padded) - 8 - depth, 0)]
    window = starts[scored[depth:]]
    context = window & np.uint64((1 << 8 * depth) - 1)
    keys = (context << np.uint64(8)) | ((window >> np.uint64(8 * depth)) & np.uint64(0xFF))
    return keys, np.repeat(np.arange(n, dtype=np.int32), sizes + 1)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and of the end of each text, and its row."""
    n = len(offsets) - 1
    lower = LOWER[data]
    starts, ends, row = word_spans(lower, offsets, NON_SPACE)
    return np.concatenate([span_hashes(lower, starts, ends), np.full(n, _END_WORD)]), np.concatenate([row, np.arange(n)]).astype(np.int32)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Ascending distinct keys; a sort, which is faster here than the library's hash table."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _nearest(keys: np.ndarray, depth: int) -> np.ndarray:
    """The two bytes before the scored one: subtrees of depth 2 and deeper share nothing across them."""
    return keys >> np.uint64(8 * (depth - 1))


def _by_shard(kind: int, keys: np.ndarray, shards: int, depth: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shard and positions (keys ascending) of the distinct sorted ``keys``."""
    spread = mix(_nearest(keys, depth)) if kind == _BYTES else keys
    shard = (spread % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(bounds)):
        yield int(s), order[bounds[s] : bounds[s + 1]]


def _train(depth: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, "text", PAGE_BYTES):
            learned = ~part.column("held_out").to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            for kind, of in ((_WORDS, _tokens), (_BYTES, lambda d, o: strings(d, o, depth))):
                keys, row = of(data, offsets)
                keys = keys[learned[row]]
                del row
                distinct, counts = np.unique(keys, return_counts=True)
                out += [(kind, s, packed_keys(distinct[at]), packed_numbers(counts[at].astype("<i8"))) for s, at in _by_shard(kind, distinct, shards, depth)]
            yield _packed(out, ["kind", "shard", "keys", "counts"])

    return run


def _packed(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "shard": pa.int32(), "page": pa.int64()}
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds.get(n, pa.binary())) for n, c in zip(names, columns)], names)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and summed counts."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")  # sorted runs merge fast
    all_keys, all_counts = all_keys[order], all_counts[order]
    first = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]])) if len(all_keys) else np.zeros(0, np.int64)
    return all_keys[first], np.add.reduceat(all_counts, first) if len(first) else all_counts


def _sum_shard(table: pa.Table) -> pa.Table:
    keys, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
    distinct, totals = _merge([unpacked_keys(k) for k in keys], [unpacked_numbers(c, "<i8") for c in counts])
    return pa.table(
        {
            "kind": table.column("kind").slice(0, 1),
            "shard": table.column("shard").slice(0, 1),
            "keys": pa.array([packed_keys(distinct)], pa.binary()),
            "counts": pa.array([packed_numbers(totals)], pa.binary()),
            "n_keys": pa.array([len(distinct)], pa.int64()),
            "total": pa.array([int(totals.sum())], pa.int64()),
        }
    )


# --- the tree -------------------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, shifted by eight."""
    y = x + 8
    below = np.zeros_like(x)
    for i in range(8):
        below += np.log(x + i)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - below


_TABLE = 1 << 16
_HALF, _WHOLE = _log_gamma(np.arange(_TABLE) + 0.5), _log_gamma(np.arange(_TABLE) + 1.0)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence of a zeros and b ones (whole numbers)."""
    n = a + b
    small = n < _TABLE
    if small.all():
        return _HALF[a.astype(np.int64)] + _HALF[b.astype(np.int64)] - _WHOLE[n.astype(np.int64)] - np.log(np.pi)
    out = np.empty(len(a))
    out[small] = log_kt(a[small], b[small])
    x, y = a[~small], b[~small]
    out[~small] = _log_gamma(x + 0.5) + _log_gamma(y + 0.5) - _log_gamma(x + y + 1.0) - np.log(np.pi)
    return out


def _weigh(a: np.ndarray, b: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """log P_w of nodes and the weight of stopping there; ``below`` sums log P_w of the children."""
    kt = log_kt(a, b)
    if below is None:
        return kt, np.ones(len(a))
    return np.logaddexp(kt, below) - np.log(2), 1 / (1 + np.exp(np.clip(below - kt, -700, 700)))


class Level:
    """Nodes of one depth: ``entries`` are the distinct (context, byte), ascending; for each of the eight decisions
    the nodes are runs of entries, ``node[k]`` tells an entry's run."""

    def __init__(self, entries: np.ndarray, counts: np.ndarray, child: "Level | None", up: np.ndarray | None):
        """``up`` gives the entry here of each entry of ``child``, the next depth."""
        self.entries, self.counts, self.up = entries, counts, up
        byte = entries & np.uint64(0xFF)
        context = entries & ~np.uint64(0xFF)
        self.node, self.key, self.first, self.a, self.b, self.log_pw, self.stop = ([] for _ in range(7))
        for k in range(8):
            key = context | np.uint64(1 << k) | (byte >> np.uint64(8 - k))
            start = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
            node, first = np.cumsum(start) - 1, np.flatnonzero(start)
            total = np.bincount(node, weights=counts, minlength=len(first))
            ones = np.bincount(node, weights=counts * ((byte >> np.uint64(7 - k)) & np.uint64(1)), minlength=len(first))
            below = None
            if child is not None:
                below = np.bincount(node[up[child.first[k]]], weights=child.log_pw[k], minlength=len(first))
            log_pw, stop = _weigh(total - ones, ones, below)
            for have, new in zip((self.node, self.key, self.first, self.a, self.b, self.log_pw, self.stop), (node, key[first], first, total - ones, ones, log_pw, stop)):
                have.append(new)
        self.one = [(b + 0.5) / (a + b + 1) for a, b in zip(self.a, self.b)]


def build_levels(keys: np.ndarray, counts: np.ndarray, depth: int, lowest: int) -> dict[int, Level]:
    """Levels ``depth`` down to ``lowest`` of the tree of these ascending strings."""
    levels = {depth: Level(keys, counts.astype(np.float64), None, None)}
    for d in range(depth - 1, lowest - 1, -1):
        child = levels[d + 1]
        # without its farthest byte
        shorter = ((child.entries >> np.uint64(16)) << np.uint64(8)) | (child.entries & np.uint64(0xFF))
        entries, up = np.unique(shorter, return_inverse=True)
        levels[d] = Level(entries, np.bincount(up, weights=child.counts, minlength=len(entries)), child, up)
    return levels


def _entries(level: Level, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted entry, -1 where there is none."""
    if not len(level.entries):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(level.entries, wanted), len(level.entries) - 1)
    return np.where(level.entries[at] == wanted, at, -1)


def _nodes(level: Level, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Node of each decision of the entries at these places, -1 where training never came there."""
    out = np.full((8, len(wanted)), -1)
    hit = np.flatnonzero(at >= 0)
    for k in range(8):
        out[k, hit] = level.node[k][at[hit]]
    left = np.flatnonzero(at < 0) if len(level.entries) else np.zeros(0, np.int64)
    for k in range(8):
        if not len(left):
            break
        # the first bits of a byte that never followed may have
        e = wanted[left]
        key = (e & ~np.uint64(0xFF)) | np.uint64(1 << k) | ((e & np.uint64(0xFF)) >> np.uint64(8 - k))
        place = np.minimum(np.searchsorted(level.key[k], key), len(level.key[k]) - 1)
        there = level.key[k][place] == key
        left = left[there]
        out[k, left] = place[there]
    return out


def byte_scores(keys: np.ndarray, levels: dict[int, Level], depth: int) -> np.ndarray:
    """log10 probability of each string's byte after its context."""
    byte = keys & np.uint64(0xFF)
    bits = [(byte >> np.uint64(7 - k)) & np.uint64(1) == 1 for k in range(8)]
    p = np.full((8, len(keys)), 0.5)
    deeper = np.zeros(p.shape, dtype=bool)
    child = at = None
    for d in range(depth, -1, -1):
        level = levels.get(d)
        if level is None:
            continue
        context = keys >> np.uint64(8 * (depth - d + 1)) if d else np.zeros_like(keys)
        wanted = (context << np.uint64(8)) | byte
        if child is not None and level.up is not None and len(level.up) == len(child.entries):
            # what is known at the next depth is known here: only the others are looked up
            known = at >= 0
            here = np.full(len(keys), -1)
            here[known] = level.up[at[known]]
            here[~known] = _entries(level, wanted[~known])
        else:
            here = _entries(level, wanted)
        child, at = level, here
        nodes = _nodes(level, wanted, at)
        for k in range(8):
            seen = np.flatnonzero(nodes[k] >= 0)
            if not len(seen):
                break
            node = nodes[k, seen]
            one = level.one[k][node]
            kt = np.where(bits[k][seen], one, 1 - one)
            w = np.where(deeper[k, seen], level.stop[k][node], 1.0)
            p[k, seen] = w * kt + (1 - w) * p[k, seen]
            deeper[k, seen] = True
    return np.log10(p).sum(axis=0)


def _subtrees(keys: np.ndarray, depth: int, limit: int) -> list[slice]:
    """Ascending strings cut into groups of whole subtrees of about ``limit``."""
    near = _nearest(keys, depth)
    starts = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]])) if len(keys) else np.zeros(0, np.int64)
    cuts = [0]
    for at, nxt in zip(starts[1:].tolist(), [*starts[2:].tolist(), len(keys)]):
        if nxt - cuts[-1] > limit:
            cuts.append(at)
    return [slice(lo, hi) for lo, hi in zip(cuts, [*cuts[1:], len(keys)])] if len(keys) else []


_ROOTS = "parent long, below double, entry long, n double"


def _shard_roots(depth: int):
    """What depth 1 needs of each subtree: log P_w of the nodes of depth 2 by parent node, and counts by (nearest byte, byte)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, numbers in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                keys, counts = unpacked_keys(raw), unpacked_numbers(numbers, "<i8")
                for group in _subtrees(keys, depth, GROUP_KEYS):
                    two = build_levels(keys[group], counts[group], depth, 2)[2]
                    shorter = lambda key: (((key >> np.uint64(16)) << np.uint64(8)) | (key & np.uint64(0xFF))).astype(np.int64)
                    parent, at = np.unique(shorter(np.concatenate(two.key)), return_inverse=True)
                    below = np.bincount(at, weights=np.concatenate(two.log_pw), minlength=len(parent))
                    entry, at = np.unique(shorter(two.entries), return_inverse=True)
                    n = np.bincount(at, weights=two.counts, minlength=len(entry))
                    yield pa.RecordBatch.from_arrays([pa.array(parent), pa.array(below), pa.nulls(len(parent), pa.int64()), pa.nulls(len(parent), pa.float64())], ["parent", "below", "entry", "n"])
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(entry), pa.int64()), pa.nulls(len(entry), pa.float64()), pa.array(entry), pa.array(n)], ["parent", "below", "entry", "n"])
        give_back()

    return run


def _top_levels(model: DataFrame, depth: int) -> dict[int, Level]:
    """Levels 1 and 0: at most 256 * 255 and 256 * 256 aggregated rows reach the driver."""
    roots = model.where(f"kind = {_BYTES}").select("keys", "counts").mapInArrow(_shard_roots(depth), _ROOTS)
    rows = roots.groupBy("parent", "entry").agg(F.sum("below").alias("below"), F.sum("n").alias("n")).collect()
    below = {r["parent"]: r["below"] for r in rows if r["parent"] is not None}
    counted = sorted((r["entry"], r["n"]) for r in rows if r["entry"] is not None)
    entries, counts = np.array([e for e, _ in counted], np.uint64), np.array([n for _, n in counted], float)
    one = Level(entries, counts, None, None)
    for k in range(8):
        one.log_pw[k], one.stop[k] = _weigh(one.a[k], one.b[k], np.array([below[int(key)] for key in one.key[k]], float))
    zero, up = np.unique(entries & np.uint64(0xFF), return_inverse=True)
    return {1: one, 0: Level(zero, np.bincount(up, weights=counts, minlength=len(zero)) if len(zero) else counts, one, up)}


def _ask(depth: int, shards: int):
    """The distinct keys of a page, by shard."""

    def run(table: pa.Table) -> pa.Table:
        data, offsets = text_buffer(table.column("text").combine_chunks())
        page = table.column("page")[0].as_py()
        asked = ((_WORDS, _distinct(_tokens(data, offsets)[0])), (_BYTES, _distinct(strings(data, offsets, depth)[0])))
        rows = [(page, kind, s, packed_keys(d[at])) for kind, d in asked for s, at in _by_shard(kind, d, shards, depth)]
        return pa.Table.from_batches([_packed(rows, ["page", "kind", "shard", "keys"])])

    return run


def _answer(depth: int, top: dict[int, Level]):
    """Counts of words, and scores of byte strings, in the order they were asked for."""

    def run(asked: pa.Table, shard: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.Table.from_batches([_packed([], ["page", "kind", "shard", "values"])])
        parts = [unpacked_keys(raw) for raw in asked.column("keys").to_pylist()]
        sizes = np.cumsum([0, *map(len, parts)])
        distinct, at = np.unique(np.concatenate(parts), return_inverse=True)
        keys = unpacked_keys(shard.column("keys")[0].as_py()) if shard.num_rows else np.zeros(0, np.uint64)
        counts = unpacked_numbers(shard.column("counts")[0].as_py(), "<i8") if shard.num_rows else np.zeros(0, "<i8")
        values = np.zeros(len(distinct))
        if asked.column("kind")[0].as_py() == _WORDS:
            if len(keys):
                where = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
                values = np.where(keys[where] == distinct, counts[where], 0).astype(np.float64)
        else:
            groups = _subtrees(keys, depth, GROUP_KEYS) or [slice(0, 0)]
            # a string belongs to the last group that begins at or before its two nearest bytes
            edges = [0, *(np.searchsorted(_nearest(distinct, depth), _nearest(keys[g.start : g.start + 1], depth)[0]) for g in groups[1:]), len(distinct)]
            for group, lo, hi in zip(groups, edges[:-1], edges[1:]):
                if lo < hi:
                    levels = top | (build_levels(keys[group], counts[group], depth, 2) if group.stop else {})
                    for i in range(lo, hi, SCORE_KEYS):
                        values[i : min(i + SCORE_KEYS, hi)] = byte_scores(distinct[i : min(i + SCORE_KEYS, hi)], levels, depth)
        values = values[at]
        rows = [(p, k, s, packed_numbers(values[lo:hi], SCORE_PLANES)) for p, k, s, lo, hi in zip(*(asked.column(c).to_pylist() for c in ("page", "kind", "shard")), sizes[:-1], sizes[1:])]
        return pa.Table.from_batches([_packed(rows, ["page", "kind", "shard", "values"])])

    return run


def _score(depth: int, shards: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        n = texts.num_rows
        data, offsets = text_buffer(texts.column("text").combine_chunks()) if n else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        got = {(k, s): v for k, s, v in zip(*(answers.column(c).to_pylist() for c in ("kind", "shard", "values")))}

        def answered(kind: int, keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Each key's value and row, in the order of the keys."""
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            distinct, values = keys[first], np.zeros(len(first))
            for s, where in _by_shard(kind, distinct, shards, depth):
                values[where] = unpacked_numbers(got[kind, s], np.float64, SCORE_PLANES)
            return np.repeat(values, np.diff(np.append(first, len(keys)))), row[order]

        c, word_row = answered(_WORDS, *_tokens(data, offsets))
        logs, byte_row = answered(_BYTES, *strings(data, offsets, depth))
        known = np.bincount(word_row, weights=c > 0, minlength=n).astype(np.int64)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": np.bincount(word_row, minlength=n).astype(np.int64),
                "n_known": known,
                "log_counts": np.bincount(word_row, weights=np.log10(c + 0.5), minlength=n),
                "score": np.bincount(byte_row, weights=logs, minlength=n),
                "n_bytes": np.diff(offsets) + 1,
            }
        )

    return run


def score_texts(docs: DataFrame, *, folds: int = 5, held_remainder: int = 1, depth: int = DEPTH, page_bytes: int = PAGE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every row.

    Rows whose id's CRC-32 leaves ``held_remainder`` modulo ``folds`` are held out of training.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth must be 2 to 7 bytes")
    rows = doc_rows(docs)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_remainder, F.lit(False))
    rows = rows.withColumn("held_out", held)
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    shards = int(size // shard_bytes) + 8
    pages = int(size // page_bytes) + 8
    counted = rows.mapInArrow(_train(depth, shards), "kind int, shard int, keys binary, counts binary")
    model = counted.groupBy("kind", "shard").applyInArrow(_sum_shard, "kind int, shard int, keys binary, counts binary, n_keys long, total long")
    model = stored(model, "context_tree")
    words = model.where(f"kind = {_WORDS}").agg(F.sum("n_keys").alias("v"), F.sum("total").alias("n")).first()
    n, v = words["n"] or 0, words["v"] or 0
    top = _top_levels(model, depth)
    paged = rows.withColumn("page", F.pmod(F.xxhash64("doc_id", "text"), F.lit(pages)))
    asked = paged.groupBy("page").applyInArrow(_ask(depth, shards), "page long, kind int, shard int, keys binary")
    answers = (
        asked.groupBy("kind", "shard")
        .cogroup(model.select("kind", "shard", "keys", "counts").groupBy("kind", "shard"))
        .applyInArrow(_answer(depth, top), "page long, kind int, shard int, values binary")
    )
    scored = (
        paged.groupBy("page")
        .cogroup(answers.groupBy("page"))
        .applyInArrow(_score(depth, shards), "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double, n_bytes long")
    )
    base = F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
