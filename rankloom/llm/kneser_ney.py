"""Quality by interpolated modified Kneser-Ney perplexity, thresholded per language.

The model is over bytes: strings of ``order`` bytes (zeros before a text, an end byte 0 after it) are
counted in all trusted documents (labelled of good quality and not toxic). The highest order has raw
counts, each lower one the number of distinct longer strings that end in it. Discounts for counts of
one, two and three or more come from counts of counts; what they free goes to the next lower order,
down to a uniform one.

Counts are packed per slice, summed by shard and stored. A shard holds all strings whose last byte
follows the same two bytes, so every order from three up is whole inside its shard; each shard gives
its counts of counts and its part of order two, which is at most 65,536 numbers and, with order one,
goes to all tasks. Texts are packed where they are read into compressed pages of bounded size; a page asks
the shards for its distinct strings and their answers are joined back to the page. A shard asked by many
pages answers in several tasks. Texts should come from a stored table, so that a lost task packs the same
pages again.

Every text gets its perplexity per byte. A language's threshold is the ``quantile`` of the perplexity of
its trusted documents (all of them); a language without any takes that of all languages together. A
document is kept if its perplexity is at most its threshold.

Null and empty texts consist of their end byte and are scored like others. Rows are scored one by one;
repeated rows keep theirs and null ids are never trusted. Without trusted documents all are kept, with
perplexity 256. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.byte_strings import PAGE_BYTES, SHARD_BYTES, _by_shard, _BYTES, _keys, _sum_shard
from rankloom.llm.kernels import give_back, text_buffer, text_slices
from rankloom.llm.tables import bounded_batches, join_by, stored

ORDER = 5
QUANTILE = 0.99
PAGES_PER_TASK = 1024


def _count(order: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in text_slices(batches, "text", PAGE_BYTES):
            codes, counts = np.unique(_keys(data, offsets, order - 1)[2], return_counts=True)
            rows = [(_BYTES, s, codes[at].tobytes(), counts[at].astype("<i8").tobytes()) for s, at in _by_shard(_BYTES, codes, shards)]
            yield pa.RecordBatch.from_pylist([dict(zip(("kind", "shard", "keys", "counts"), r)) for r in rows], pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    return run


@dataclass(frozen=True)
class OrderTable:
    """One order: strings with their discounted counts, contexts with their totals and freed mass."""

    keys: np.ndarray
    discounted: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    freed: np.ndarray


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in range(1, 5)]


def discounts(n: list[int]) -> np.ndarray:
    """Discount for counts 0, 1, 2 and 3 or more, from the counts of counts 1 to 4."""
    if not all(n):
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))])


def order_counts(codes: np.ndarray, counts: np.ndarray, order: int, lowest: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Strings and counts of the orders ``order`` down to ``lowest`` from the distinct longest strings."""
    keys, have = codes, counts.astype(np.float64)
    found = {order: (keys, have)}
    for n in range(order - 1, lowest - 1, -1):
        keys, longer = np.unique(keys & np.uint64((1 << 8 * n) - 1), return_counts=True)
        found[n] = (keys, longer.astype(np.float64))
    return found


def order_table(keys: np.ndarray, have: np.ndarray, discount: np.ndarray) -> OrderTable:
    by_count = discount[np.minimum(have, 3).astype(int)]
    contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
    totals = np.bincount(at, weights=have, minlength=len(contexts))
    freed = np.bincount(at, weights=by_count, minlength=len(contexts)) / totals
    return OrderTable(keys, have - by_count, contexts, totals, freed)


def build_tables(codes: np.ndarray, counts: np.ndarray, order: int) -> list[OrderTable]:
    """Tables of orders 1 to ``order`` from the distinct longest strings of a whole collection."""
    found = order_counts(codes, counts, order, 1)
    return [order_table(*found[n], discounts(counts_of_counts(found[n][1]))) for n in range(1, order + 1)]


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def probabilities(codes: np.ndarray, tables: list[OrderTable]) -> np.ndarray:
    """Probability of each string's last byte after the ones before it."""
    p = np.full(len(codes), 1 / 256)
    for n, t in enumerate(tables, 1):
        keys = codes & np.uint64((1 << 8 * n) - 1)
        c, known = _find(t.contexts, keys >> np.uint64(8))
        k, there = _find(t.keys, keys)
        p = np.where(known, np.where(there, t.discounted[k], 0.0) / t.totals[c] + t.freed[c] * p, p)
    return p


def _unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(keys, np.uint64), np.frombuffer(counts, "<i8")


def _shard_sums(order: int):
    """Of each shard: counts of counts of the orders from three (key: the count), and order two's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                found = order_counts(*_unpack(keys, counts), order, 3)
                two, longer = np.unique(found[3][0] & np.uint64(0xFFFF), return_counts=True)
                rows = [(n, k, c) for n, (_, have) in found.items() for k, c in enumerate(counts_of_counts(have), 1)]
                rows += [(2, k, c) for k, c in zip(two.tolist(), longer.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))], ["n", "key", "c"])
        give_back()

    return run


@dataclass(frozen=True)
class Model:
    """Shards of the longest strings; the two lowest orders and all discounts, which are small."""

    order: int
    shards: int
    counts: DataFrame
    low: list[OrderTable]
    discount: dict[int, np.ndarray]


def fit(docs: DataFrame, trusted: DataFrame, shards: int, *, order: int = ORDER) -> Model:
    """Model of the texts of ``docs`` whose ids are in ``trusted`` (distinct doc_ids)."""
    texts = join_by(docs, trusted, ["doc_id"], "left_semi").select("text")
    counted = texts.mapInArrow(_count(order, shards), "kind int, shard int, keys binary, counts binary")
    summed = counted.groupBy("kind", "shard").applyInArrow(_sum_shard, "kind int, shard int, keys binary, counts binary, n_keys long, total long")
    model = stored(summed.select("shard", "keys", "counts"), "kneser_ney")
    sums = model.mapInArrow(_shard_sums(order), "n int, key long, c long").groupBy("n", "key").agg(F.sum("c").alias("c"))
    rows = sums.orderBy("n", "key").collect()  # at most 65,536 strings of two bytes and four numbers an order
    if not rows:
        return Model(order, shards, model, [], {})
    two = np.array([r["key"] for r in rows if r["n"] == 2], np.uint64)
    low = order_counts(two, np.array([r["c"] for r in rows if r["n"] == 2]), 2, 1)
    of = {n: [r["c"] for r in rows if r["n"] == n] for n in range(3, order + 1)}
    tables = [order_table(*low[n], discounts(counts_of_counts(low[n][1]))) for n in (1, 2)]
    return Model(order, shards, model, tables, {n: discounts(c) for n, c in of.items()})


def _pack(page_bytes: int):
    """Rows as compressed pages of at most ``page_bytes`` of text, numbered within their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for n, (part, _, _) in enumerate(text_slices(batches, "text", page_bytes)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                writer.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([first + n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["page", "packed"])

    return run


def _unpacked(page: pa.Table) -> pa.Table:
    return pa.ipc.open_stream(page.column("packed")[0].as_buffer()).read_all()


def _planes(values: np.ndarray) -> bytes:
    """Eight-byte values as their first bytes, their second bytes and so on, which compress well in order."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes, dtype: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(dtype).ravel()


def _ask(order: int, shards: int):
    """The distinct strings of a page, by shard."""

    def run(table: pa.Table) -> pa.Table:
        data, offsets = text_buffer(_unpacked(table).column("text").combine_chunks())
        distinct = np.unique(_keys(data, offsets, order - 1)[2])
        page = table.column("page")[0].as_py()
        parts = [(s, _planes(distinct[at])) for s, at in _by_shard(_BYTES, distinct, shards)]
        n = len(parts)
        return pa.table({"page": pa.array([page] * n, pa.int64()), "shard": pa.array([s for s, _ in parts], pa.int32()), "keys": pa.array([k for _, k in parts], pa.binary())})

    return run


def _answer(order: int, low: list[OrderTable], discount: dict[int, np.ndarray]):
    """Log probabilities of the strings asked for, in their order."""

    def run(asked: pa.Table, shard: pa.Table) -> pa.Table:
        keys = [_from_planes(x, np.uint64) for x in asked.column("keys").to_pylist()]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        tables = list(low)
        if shard.num_rows:
            found = order_counts(*_unpack(shard.column("keys")[0].as_py(), shard.column("counts")[0].as_py()), order, 3)
            tables += [order_table(*found[n], discount[n]) for n in range(3, order + 1)]
        logs = np.log(probabilities(distinct, tables))[at]
        ends = np.cumsum([0, *map(len, keys)])
        values = [_planes(logs[lo:hi]) for lo, hi in zip(ends[:-1], ends[1:])]
        return pa.table({"page": asked.column("page"), "shard": asked.column("shard"), "logs": pa.array(values, pa.binary())})

    return run


def _perplexity(order: int, shards: int):
    def run(page: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _unpacked(page)
        data, offsets = text_buffer(texts.column("text").combine_chunks())
        _, _, codes, row = _keys(data, offsets, order - 1)
        got = dict(zip(answers.column("shard").to_pylist(), answers.column("logs").to_pylist()))
        distinct, at = np.unique(codes, return_inverse=True)
        logs = np.zeros(len(distinct))
        for s, where in _by_shard(_BYTES, distinct, shards):
            logs[where] = _from_planes(got[s], np.float64)
        mean = np.bincount(row, weights=logs[at], minlength=texts.num_rows) / (np.diff(offsets) + 1)
        return pa.table({"doc_id": texts.column("doc_id"), "lang": texts.column("lang"), "perplexity": pa.array(np.exp(-mean))})

    return run


def perplexities(rows: DataFrame, model: Model, pages: int, *, page_bytes: int = PAGE_BYTES, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """``doc_id, lang, perplexity`` of every row of ``rows`` (doc_id, lang, text).

    ``pages`` is about the number of pages to expect; a shard answers ``pages_per_task`` of them in one task.
    """
    slots = -(-pages // pages_per_task)
    paged = rows.select("doc_id", "lang", "text").mapInArrow(_pack(page_bytes), "page long, packed binary")
    asked = paged.groupBy("page").applyInArrow(_ask(model.order, model.shards), "page long, shard int, keys binary")
    asked = asked.withColumn("slot", F.pmod(F.xxhash64("page"), F.lit(slots)).cast("int"))
    spread = model.counts.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    answers = asked.groupBy("shard", "slot").cogroup(spread.groupBy("shard", "slot")).applyInArrow(_answered(model), "page long, shard int, logs binary")
    return paged.groupBy("page").cogroup(answers.groupBy("page")).applyInArrow(_perplexity(model.order, model.shards), "doc_id long, lang string, perplexity double")


def _answered(model: Model):
    run = _answer(model.order, model.low, model.discount)

    def some(asked: pa.Table, shard: pa.Table) -> pa.Table:
        if asked.num_rows:
            return run(asked, shard)
        return pa.table({"page": pa.array([], pa.int64()), "shard": pa.array([], pa.int32()), "logs": pa.array([], pa.binary())})

    return some


def quality(docs: DataFrame, labels: DataFrame, *, order: int = ORDER, quantile: float = QUANTILE, page_bytes: int = PAGE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, perplexity, threshold, kept`` of every row of ``docs`` (doc_id, text, lang)."""
    if not 3 <= order <= 8:
        raise ValueError("order must be 3 to 8 bytes")
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    trusted = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    model = fit(rows, trusted, int(size // shard_bytes) + 8, order=order)
    scored = stored(perplexities(rows, model, int(size // page_bytes) + 8, page_bytes=page_bytes), "perplexity")
    good = join_by(scored, trusted, ["doc_id"], "left_semi")
    by_lang = good.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 100_000).alias("own"))
    overall = good.agg(F.percentile_approx("perplexity", quantile, 100_000).alias("q")).first()["q"]
    out = join_by(scored, stored(by_lang, "perplexity_thresholds"), ["lang"], "left")
    out = out.withColumn("threshold", F.coalesce("own", F.lit(overall if overall is not None else float("inf"))))
    return out.select("doc_id", "perplexity", "threshold", (F.col("perplexity") <= F.col("threshold")).alias("kept"))
