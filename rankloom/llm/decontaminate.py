"""Benchmark decontamination by winnowed k-gram fingerprints.

Words are runs of ASCII digits and letters (A-Z lower-cased) and of any characters beyond ASCII.
A window is ``span`` consecutive words of a benchmark item; an item with fewer words is one
window as a whole. Every document word inside an occurrence of a window is hit.

In each window of ``span`` words the right-most smallest hash of its ``span - gram + 1`` k-grams is
kept. The choice depends on the window alone, so two equal windows keep the same k-gram at the same
place: joining fingerprints finds every shared window. A fingerprint carries the word hashes around
it, as far as a window that kept it can reach; comparing them extends a hit to all shared windows,
so texts are never shuffled. Items below the guarantee are matched by the hash of all their words.

A Bloom filter of the benchmark (fixed size, built by an aggregate) drops document fingerprints that
can't match before anything is shuffled; a full filter only drops fewer.

Null and empty texts have no words and no hits; null or empty items have no windows. Documents
with the same id and the same text are one row; ids may be null; the same item text under several
ids counts for each. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.kernels import ALNUM, LOWER, gram_hashes, ragged, span_hashes, text_slices, word_spans
from rankloom.llm.tables import bloom_words, doc_rows, in_bloom, join_by, stored

SPAN = 10
GRAM = 6
BLOOM_BITS = 1 << 24

_FIELDS = "n long, fp long, pos int, before binary, after binary"


def _last_min(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the right-most minimum of each window of ``width`` values."""
    windows = np.lib.stride_tricks.sliding_window_view(values, width)[:, ::-1]
    return np.arange(len(windows)) + width - 1 - np.argmin(windows, axis=1)


def _around(words: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """Binary column of the word hashes ``words[lo:hi]`` for each pair of bounds."""
    counts = hi - lo
    offsets = np.zeros(len(lo) + 1, dtype=np.int32)
    np.cumsum(counts * 8, out=offsets[1:])
    index = np.repeat(lo - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum())) if len(lo) else np.zeros(0, np.int64)
    return pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(offsets), pa.py_buffer(words[index].tobytes())])


class _Fingerprints:
    """Fingerprints of one slice: window fingerprints have n = span, whole short items n < span."""

    def __init__(self, span: int, gram: int):
        self.span, self.gram = span, gram

    def of(self, data: np.ndarray, offsets: np.ndarray, lengths: list[int] | None, bloom: np.ndarray | None):
        """Rows' word counts, and of every fingerprint: row, n, hash, word position, word bounds around it.

        ``lengths``: also all n-grams of these lengths; None: each row shorter than a window as a whole.
        """
        lower = LOWER[data]
        starts, ends, row = word_spans(lower, offsets, ALNUM)
        words = span_hashes(lower, starts, ends)
        n_rows = len(offsets) - 1
        per_row = np.bincount(row, minlength=n_rows)
        first = np.concatenate([[0], np.cumsum(per_row)])
        out = []
        if len(words) >= self.span:
            grams = gram_hashes(words, self.gram)
            width = self.span - self.gram + 1
            whole = row[: len(words) - self.span + 1] == row[self.span - 1 :]
            at = np.unique(_last_min(grams, width)[: len(whole)][whole])
            fp = grams[at]
            if bloom is not None:
                keep = in_bloom(bloom, fp)
                at, fp = at[keep], fp[keep]
            r = row[at]
            lo = np.maximum(at - (self.span - self.gram), first[r])
            hi = np.minimum(at + self.span, first[r + 1])
            out.append((r, np.full(len(at), self.span), fp, at, lo, hi))
        for n in range(1, self.span) if lengths is None else lengths:
            if len(words) < n:
                continue
            if lengths is None:
                r = np.flatnonzero(per_row == n)
                at = first[r]
                fp = gram_hashes(words, n)[at]
            else:
                ok = row[: len(words) - n + 1] == row[n - 1 :]
                at = np.flatnonzero(ok)
                fp = gram_hashes(words, n)[at]
                if bloom is not None:
                    keep = in_bloom(bloom, fp)
                    at, fp = at[keep], fp[keep]
                r = row[at]
            out.append((r, np.full(len(at), n), fp, at, at, at))
        joined = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 6
        return per_row, first, words, joined


def _arrays(found, first: np.ndarray, words: np.ndarray, order: np.ndarray) -> list[pa.Array]:
    r, n, fp, at, lo, hi = (x[order] for x in found)
    return [
        pa.array(n.astype(np.int64)),
        pa.array(fp.astype(np.uint64).view(np.int64)),
        pa.array((at - first[r]).astype(np.int32)),
        _around(words, lo, at),
        _around(words, at, hi),
    ]


def _map_items(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = _Fingerprints(span, gram)
        for part, data, offsets in text_slices(batches, "text"):
            _, first, words, found = kernel.of(data, offsets, None, None)
            order = np.arange(len(found[0]))
            yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(found[0])), *_arrays(found, first, words, order)], ["item_id", "n", "fp", "pos", "before", "after"])

    return run


def _map_docs(span: int, gram: int, lengths: list[int], bloom: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = _Fingerprints(span, gram)
        for part, data, offsets in text_slices(batches, "text"):
            per_row, first, words, found = kernel.of(data, offsets, lengths, bloom)
            order = np.argsort(found[0], kind="stable")
            columns = _arrays(found, first, words, order)
            counts = np.bincount(found[0].astype(np.int64), minlength=part.num_rows)
            bounds = np.zeros(part.num_rows + 1, dtype=np.int32)
            np.cumsum(counts, out=bounds[1:])
            hits = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, ["n", "fp", "pos", "before", "after"]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), pa.array(per_row.astype(np.int64)), hits], ["doc_id", "key", "n_words", "hits"])

    return run


def _shared(a: np.ndarray, a_at: int, b: np.ndarray, b_at: int) -> int:
    """Length of the common prefix of ``a[a_at:]`` and ``b[b_at:]``."""
    n = min(len(a) - a_at, len(b) - b_at)
    differ = np.flatnonzero(a[a_at : a_at + n] != b[b_at : b_at + n])
    return int(differ[0]) if len(differ) else n


def _extend(span: int):
    """Word range that document and item share around a fingerprint, where it is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi = [], []
            columns = [batch.column(c).to_pylist() for c in ("n", "pos", "before", "after", "i_before", "i_after")]
            for n, pos, before, after, i_before, i_after in zip(*columns):
                if i_after is None:
                    lo.append(None)
                    hi.append(None)
                elif n < span:
                    lo.append(pos)
                    hi.append(pos + n)
                else:
                    d, i = np.frombuffer(before, np.uint64)[::-1], np.frombuffer(i_before, np.uint64)[::-1]
                    left = _shared(d, 0, i, 0)
                    right = _shared(np.frombuffer(after, np.uint64), 0, np.frombuffer(i_after, np.uint64), 0)
                    good = left + right >= span
                    lo.append(pos - left if good else None)
                    hi.append(pos + right if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), batch.column("n_words"), batch.column("item_id"), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                ["doc_id", "key", "n_words", "item_id", "lo", "hi"],
            )

    return run


def find_overlaps(docs: DataFrame, items: DataFrame, *, span: int = SPAN, gram: int = GRAM, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """One row per document: ``doc_id, key, n_words, spans, items``.

    ``spans``: ascending, disjoint ``(lo, hi)`` word ranges that are hit; ``items``: the items found.
    """
    bench = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bench = stored(bench.mapInArrow(_map_items(span, gram), f"item_id long, {_FIELDS}"), "bench_fingerprints")
    lengths = sorted(r["n"] for r in bench.where(F.col("n") < span).select("n").distinct().collect())
    bloom = bloom_words(bench, "fp", bloom_bits)
    rows = doc_rows(docs).withColumn("key", F.xxhash64("text"))
    found = rows.mapInArrow(_map_docs(span, gram, lengths, bloom), f"doc_id long, key long, n_words long, hits array<struct<{_FIELDS.replace(' ', ':').replace(',:', ',')}>>")
    found = found.select("doc_id", "key", "n_words", F.explode_outer("hits").alias("h")).select("doc_id", "key", "n_words", "h.*")
    # a document without fingerprints keeps a row; its text hash spreads such rows and n = 0 matches nothing
    found = found.withColumn("n", F.coalesce("n", F.lit(0))).withColumn("fp", F.coalesce("fp", "key"))
    side = bench.select("item_id", "n", "fp", F.col("before").alias("i_before"), F.col("after").alias("i_after")).distinct()
    matched = join_by(found, side, ["n", "fp"], "left")
    ranges = matched.mapInArrow(_extend(span), "doc_id long, key long, n_words long, item_id long, lo long, hi long")
    hit = F.when(F.col("lo").isNotNull(), F.struct("lo", "hi"))
    per_doc = ranges.groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(hit)).alias("_hits"),
        F.collect_set(F.when(F.col("lo").isNotNull(), F.col("item_id").cast("string"))).alias("items"),
    )
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    # ascending ranges: merge each into the last one while they touch
    merged = F.aggregate(
        "_hits",
        F.struct(F.lit(-1).cast("long").alias("lo"), F.lit(-1).cast("long").alias("hi"), empty.alias("done")),
        lambda acc, h: F.when(h["lo"] <= acc["hi"], F.struct(acc["lo"].alias("lo"), F.greatest(acc["hi"], h["hi"]).alias("hi"), acc["done"].alias("done"))).otherwise(
            F.struct(
                h["lo"].alias("lo"),
                h["hi"].alias("hi"),
                F.when(acc["hi"] < 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi"))))).alias("done"),
            )
        ),
        lambda acc: F.when(acc["hi"] < 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi"))))),
    )
    return per_doc.select("doc_id", "key", "n_words", merged.alias("spans"), F.sort_array("items").alias("items"))


def contamination(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans`` for every document."""
    found = find_overlaps(docs, items, **settings)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["hi"] - s["lo"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
    )
