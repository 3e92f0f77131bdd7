"""Word n-grams of whole texts, counted and weighed in blocks of rows.

Rows are dealt into blocks by their id. A block counts its n-grams in one task, names each distinct one once and keeps
its rows as numbers of these names, two to three bytes per row and n-gram. What a vocabulary knows of an n-gram is asked once
per block, not once per row; the answer goes back to the block, which weighs its rows. So only distinct n-grams of
blocks travel as strings, and none is hot: it has at most one row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rankloom.functions.text import word_tokens
from rankloom.operators.common import store

BLOCK_BYTES = 8 << 20  # of text in a block
MIN_BLOCK_BYTES = 1 << 18  # small inputs still give every core a block
NAMES_PER_BATCH = 1 << 16
NAMES_PER_RANGE = 1_000_000

_NAMES = [("_code", T.IntegerType()), ("_term", T.StringType()), ("_df", T.LongType()), ("_cf", T.LongType())]
_POSTINGS = [("_codes", T.BinaryType()), ("_tfs", T.BinaryType())]


def count_blocks(df: DataFrame, text_col: str, ngram_range: tuple[int, int], keep: Sequence[str] = ()) -> DataFrame:
    """Stored blocks of ``df``: a record per row with its keys and numbered n-grams, a record per block and distinct
    n-gram with its number, rows and occurrences (``_code`` is null in the former)."""
    low, high = ngram_range
    if not 1 <= low <= high <= 2:
        raise ValueError("n-grams of one and two words are supported")
    keys = ["row_id", *keep]
    size = df.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-size // BLOCK_BYTES), min(cores, size // MIN_BLOCK_BYTES))
    # one id is in one block, however often it occurs
    dealt = df.select(*keys, F.col(text_col).alias("_text")).repartition(n_blocks, "row_id")
    fields = [T.StructField("_b", T.IntegerType()), *[T.StructField(*f) for f in _NAMES], *[df.schema[c] for c in keys], *[T.StructField(*f) for f in _POSTINGS]]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    return store(dealt.select(*keys, word_tokens("_text").alias("_w")).mapInArrow(_counter(low, high, keys, schema), schema))


def _counter(low: int, high: int, keys: list[str], schema: T.StructType) -> Callable:
    arrow_schema = to_arrow_schema(schema)

    def grams(codes: np.ndarray, row: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and n-gram of every occurrence; an n-gram of two words is numbered behind all words."""
        rows, found = [], []
        if low == 1:
            rows.append(row)
            found.append(codes)
        if high == 2:
            at = np.flatnonzero(row[1:] == row[:-1])
            rows.append(row[at])
            found.append(n_words + codes[at] * n_words + codes[at + 1])
        return np.concatenate(rows), np.concatenate(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        block = TaskContext.get().partitionId()
        n = table.num_rows
        lists = table.column("_w")
        coded = pa.chunked_array([c.flatten() for c in lists.chunks], pa.string()).combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy())
        row, gram = grams(codes, row, len(words))
        distinct, code = np.unique(gram, return_inverse=True)
        pair, tf = np.unique(row * max(len(distinct), 1) + code, return_counts=True)
        row, code = np.divmod(pair, max(len(distinct), 1))
        df = np.bincount(code, minlength=len(distinct))
        cf = np.bincount(code, tf, minlength=len(distinct)).astype(np.int64)
        for lo in range(0, len(distinct), NAMES_PER_BATCH):
            part = distinct[lo : lo + NAMES_PER_BATCH]
            single = part[part < len(words)]
            first, second = np.divmod(part[len(single) :] - len(words), max(len(words), 1))
            terms = pa.concat_arrays([words.take(pa.array(single)), pc.binary_join_element_wise(words.take(pa.array(first)), words.take(pa.array(second)), " ")])
            at = slice(lo, lo + len(part))
            columns = {"_code": np.arange(lo, lo + len(part)), "_term": terms, "_df": df[at], "_cf": cf[at]}
            yield batch(columns, block, len(part))
        ends = np.searchsorted(row, np.arange(n + 1))
        # the numbers of a row rise, so only their steps are kept
        step = np.diff(code, prepend=0)
        at = ends[:-1][ends[:-1] < ends[1:]]
        step[at] = code[at]
        yield batch({**{c: table.column(c).combine_chunks() for c in keys}, "_codes": _packed(step, ends), "_tfs": _packed(tf, ends)}, block, n)

    def batch(columns: dict, block: int, n: int) -> pa.RecordBatch:
        arrays = []
        for f in arrow_schema:
            if f.name == "_b":
                arrays.append(pa.array(np.full(n, block, np.int32)))
            elif f.name in columns:
                v = columns[f.name]
                v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v if isinstance(v, pa.Array) else pa.array(v)
                arrays.append(v.cast(f.type))
            else:
                arrays.append(pa.nulls(n, f.type))
        return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return count


def gram_stats(blocks: DataFrame) -> DataFrame:
    """``(term, cf, df)`` over all rows of the blocks."""
    names = blocks.where(F.col("_code").isNotNull())
    return names.groupBy(F.col("_term").alias("term")).agg(F.sum("_cf").alias("cf"), F.sum("_df").alias("df"))


def number_names(blocks: DataFrame) -> DataFrame:
    """Stored ``(term, idx, df, cf, _b, _code, _first)``: every block's n-grams with their totals and their place among all.

    One record of each term is ``_first`` and the only one that names it.
    One exchange by ranges of terms: a term's records meet in a range, which counts its terms; the terms of the ranges
    before are a prefix sum.
    """
    names = blocks.where(F.col("_code").isNotNull()).select(F.col("_term").alias("term"), "_b", "_code", "_df", "_cf")
    parts = max(names.sparkSession.sparkContext.defaultParallelism, -(-names.count() // NAMES_PER_RANGE))
    ranged = names.repartitionByRange(parts, "term").sortWithinPartitions("term")
    numbered = store(ranged.mapInArrow(_number, _NUMBERED))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counted = numbered.groupBy("_p").agg((F.max("_r") + 1).alias("_n"))
    offsets = counted.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = numbered.join(F.broadcast(offsets), "_p").withColumn("idx", F.col("_before") + F.col("_r"))
    return placed.select("term", "idx", "df", "cf", "_b", "_code", "_first")


_NUMBERED = "term string, _b int, _code int, df long, cf long, _p int, _r long, _first boolean"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals and running number of every term in sorted records, and where a new one begins."""
    part, n = TaskContext.get().partitionId(), 0

    def whole(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        first = np.zeros(table.num_rows, bool)
        first[starts] = True
        term = np.cumsum(first) - 1
        total = lambda c: pa.array(np.add.reduceat(table.column(c).to_numpy(), starts)[term])
        term_once = pc.if_else(pa.array(first), table.column("term").combine_chunks(), pa.scalar(None, pa.string()))
        columns = [term_once, *[table.column(c).combine_chunks() for c in ("_b", "_code")], total("_df"), total("_cf")]
        columns += [pa.array(np.full(len(first), part, np.int32)), pa.array(n + term), pa.array(first)]
        return pa.RecordBatch.from_arrays(columns, ["term", "_b", "_code", "df", "cf", "_p", "_r", "_first"])

    held = None  # the last term's records, of which more may follow
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        term = table.column("term").combine_chunks()
        starts = np.append(0, np.flatnonzero(pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)) + 1)
        if len(starts) > 1:
            yield whole(table.slice(0, starts[-1]), starts[:-1])
            n += len(starts) - 1
        held = table.slice(starts[-1])
    if held is not None:
        yield whole(held, np.zeros(1, np.int64))


def weigh_blocks(
    blocks: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    result: T.StructType,
    form: Callable,
    sublinear: bool | None,
) -> DataFrame:
    """``form`` of every block's weighed rows, see ``_weigher``; ``known`` answers ``(_b, _code, idx, idf, …)``."""
    rows = blocks.where(F.col("_code").isNull()).select("_b", *keys, "_codes", "_tfs")
    paired = rows.groupBy("_b").cogroup(known.withColumnRenamed("_b", "_of").groupBy("_of"))
    return paired.applyInArrow(_weigher(list(keys), result, form, sublinear), result)


def _packed(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Numbers of zero or more as bytes of seven bits, one binary value for each of the rows between ``ends``."""
    size = 1 + sum((numbers >> (7 * i) > 0).astype(np.int64) for i in range(1, 5))
    start = np.append(0, np.cumsum(size))
    out = np.empty(start[-1], np.uint8)
    for i in range(size.max(initial=0)):
        has = size > i
        out[start[:-1][has] + i] = (numbers[has] >> (7 * i) & 127) | np.where(size[has] > i + 1, 128, 0)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(start[ends].astype(np.int32)), pa.py_buffer(out)])


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed numbers, and how many every row has."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    last = np.flatnonzero(raw < 128)
    n = np.diff(np.searchsorted(last, np.cumsum(np.append(0, pc.binary_length(column).to_numpy()))))
    if not len(last):
        return np.zeros(0, np.int64), n
    first = np.append(0, last[:-1] + 1)
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first), n


def _risen(step: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the steps inside every row."""
    total = np.append(0, np.cumsum(step))
    return total[1:] - np.repeat(total[np.cumsum(n) - n], n)


def _groups(rows: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every row's group of equal keys (nulls are equal), and one row of every group."""
    code = np.zeros(rows.num_rows, np.int64)
    for key in keys:
        coded = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        _, code = np.unique(code * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    _, first = np.unique(code, return_index=True)
    return code, first


def _weigher(keys: list[str], result: T.StructType, form: Callable, sublinear: bool | None) -> Callable:
    """Weights of a block: ``form(keys of groups, group, entry, weight, known)`` makes the rows.

    Rows with equal keys are one group, as long as the root of the sum of its squared weights; ``sublinear`` null
    means plain counts. ``entry`` is a place in ``known``.
    """
    arrow_schema = to_arrow_schema(result)

    def weigh(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows or not known.num_rows:
            return arrow_schema.empty_table()
        codes, n = _flat(rows.column("_codes"))
        codes = _risen(codes, n)
        tf, _ = _flat(rows.column("_tfs"))
        named = known.column("_code").to_numpy()
        place = np.full(max(codes.max(initial=0), named.max()) + 1, -1, np.int32)
        place[named] = np.arange(len(named), dtype=np.int32)
        entry = place[codes]
        found = entry >= 0
        group, first = _groups(rows, keys)
        group, entry, tf = np.repeat(group, n)[found], entry[found], tf[found].astype(np.float64)
        if sublinear is None:
            weight = tf
        else:
            weight = (1 + np.log(tf) if sublinear else tf) * known.column("idf").to_numpy()[entry]
            weight = weight / np.sqrt(np.bincount(group, weight * weight, len(first)))[group]
        made = form(rows.select(keys).take(pa.array(first)), group, entry, weight, known)
        return pa.table([c.cast(f.type) for c, f in zip(made, arrow_schema)], schema=arrow_schema)

    return weigh


def as_entries(keys: pa.Table, group: np.ndarray, entry: np.ndarray, weight: np.ndarray, known: pa.Table) -> list:
    """Keys and the array of ``(idx, weight)`` of every group that has one."""
    order = np.argsort(group, kind="stable")
    n = np.bincount(group, minlength=keys.num_rows)
    some = np.flatnonzero(n)
    idx = known.column("idx").to_numpy()[entry[order]]
    pairs = pa.StructArray.from_arrays([pa.array(idx), pa.array(weight[order])], ["idx", "weight"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n[some])).astype(np.int32)), pairs)
    return [*[c.combine_chunks() for c in keys.take(pa.array(some)).columns], lists]


def as_sums(keys: pa.Table, group: np.ndarray, entry: np.ndarray, weight: np.ndarray, known: pa.Table) -> list:
    """Sums of the weights by the last key and ``idx``."""
    label = keys.column(keys.num_columns - 1).combine_chunks().dictionary_encode(null_encoding="encode")
    if isinstance(label, pa.ChunkedArray):
        label = label.combine_chunks()
    pair, at = np.unique(label.indices.to_numpy(zero_copy_only=False)[group].astype(np.int64) * known.num_rows + entry, return_inverse=True)
    which, entry = np.divmod(pair, known.num_rows)
    idx = known.column("idx").to_numpy()[entry]
    return [label.dictionary.take(pa.array(which)), pa.array(idx), pa.array(np.bincount(at, weight, len(pair)))]


def as_votes(keys: pa.Table, group: np.ndarray, entry: np.ndarray, weight: np.ndarray, known: pa.Table) -> list:
    """Keys and, per class, the sum of weight times ``logps`` of every group that has an entry."""
    some = np.flatnonzero(np.bincount(group, minlength=keys.num_rows))
    logps = known.column("logps").combine_chunks()
    logps = logps.combine_chunks() if isinstance(logps, pa.ChunkedArray) else logps
    table = logps.flatten().to_numpy().reshape(known.num_rows, -1)
    votes = np.stack([np.bincount(group, weight * table[:, c][entry], keys.num_rows)[some] for c in range(table.shape[1])], axis=1)
    offsets = np.arange(len(some) + 1, dtype=np.int32) * table.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(votes.reshape(-1)))
    return [*[c.combine_chunks() for c in keys.take(pa.array(some)).columns], lists]
