"""Dense retrieval: encoding, normalising, quantising and exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankloom.functions.arrays import let, run_lengths
from rankloom.functions.text import null_to_empty, tech_tokens
from rankloom.functions.vectors import MIN_NORM, norm, scale, truncate_dims
from rankloom.operators.common import keep_best, top_k

# --- fixed values -----------------------------------------------------------
PRECISIONS = ("float32", "int8", "uint8", "binary", "ubinary")
UNIT_NORM_TOLERANCE = 2e-2
QUANTISE_STEPS = 255
# ----------------------------------------------------------------------------

DEFAULT_DIM = 64
BLOCK_BYTES = 32 * 1024 * 1024  # of vectors, on either side of a cell
FOUND_ROWS = 1 << 21  # of the results of one cell
MIN_BLOCK_ROWS = 500
PRODUCT_CELLS = 1 << 22  # numbers in one matrix product


def hash_encode(df: DataFrame, text_col: str = "content", dim: int = DEFAULT_DIM, out: str = "embedding") -> DataFrame:
    """Built-in encoder: signed md5 feature hashing of the tech tokens.

    Works inside the row: token codes are sorted and counted as runs, so no token
    leaves its task. A stand-in for a neural encoder, which callers plug in below.
    """
    bucket = lambda h: F.pmod(F.conv(F.substring(h, 1, 4), 16, 10).cast("int"), F.lit(dim))
    positive = lambda h: (F.substring(h, 5, 1) < "8").cast("int")
    code = lambda t: let(F.md5(t.cast("binary")), lambda h: bucket(h) * 2 + positive(h))
    codes = F.sort_array(F.transform(tech_tokens(text_col), code))

    def dense(counts: Column) -> Column:
        count_of = lambda c: F.coalesce(F.try_element_at(counts, c), F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)),
            lambda i: (count_of(i * 2 + 1) - count_of(i * 2)).cast("double"),
        )

    return df.withColumn(out, let(F.map_from_entries(run_lengths(codes)), dense))


def encode_texts(
    df: DataFrame,
    text_col: str = "content",
    *,
    make_predict_fn: Callable | None = None,
    dim: int = DEFAULT_DIM,
    batch_size: int = 64,
    truncate_dim: int | None = None,
    normalize: bool = True,
    precision: str = "float32",
    out: str = "embedding",
) -> DataFrame:
    """One vector per row. ``make_predict_fn`` loads a model once per Python worker;
    without it the built-in hash encoder runs inside the JVM."""
    if batch_size <= 0:
        raise ValueError(f"texts can't be encoded {batch_size} at a time")
    if make_predict_fn is None:
        encoded = hash_encode(df, text_col, dim, out)
    else:
        predict = predict_batch_udf(
            make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
        )
        encoded = df.withColumn(out, predict(null_to_empty(text_col)))
    encoded = encoded.withColumn(out, truncate_dims(out, truncate_dim))
    if normalize:
        encoded = l2_normalize(encoded, out)
    return quantize(encoded, precision, out)


def l2_normalize(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Unit length; the zero vector stays zero."""
    length = lambda v: F.greatest(norm(v), F.lit(MIN_NORM))
    unit = let(F.col(col), lambda v: let(length(v), lambda n: scale(v, n)))
    return df.withColumn(col, unit)


def dimension_ranges(df: DataFrame, col: str = "embedding") -> Column:
    """Scalar struct ``(lo, hi)`` of per-dimension minima and maxima."""
    per_dim = (
        df.select(F.posexplode(F.col(col).cast("array<double>")).alias("d", "x"))
        .groupBy("d")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    )
    rows = F.sort_array(F.collect_list(F.struct("d", "lo", "hi")))
    return per_dim.agg(
        F.struct(
            F.transform(rows, lambda r: r["lo"]).alias("lo"), F.transform(rows, lambda r: r["hi"]).alias("hi")
        ).alias("r")
    ).scalar()


def quantize(df: DataFrame, precision: str, col: str = "embedding") -> DataFrame:
    """Scalar or sign-bit quantisation with the ranges of ``df`` itself."""
    if precision not in PRECISIONS:
        raise ValueError(f"precision must be one of {PRECISIONS}, not {precision!r}")
    if precision == "float32":
        return df
    v = F.col(col).cast("array<double>")
    if precision in ("int8", "uint8"):
        shift = 128 if precision == "int8" else 0

        def levels(r: Column) -> Column:
            def level(x: Column, i: Column) -> Column:
                low, high = F.get(r["lo"], i), F.get(r["hi"], i)
                step = (high - low) / QUANTISE_STEPS
                return F.when(step == 0, F.lit(-shift)).otherwise(((x - low) / step - shift).cast("int"))

            return F.transform(v, level)

        return df.withColumn("_r", dimension_ranges(df, col)).withColumn(col, let(F.col("_r"), levels)).drop("_r")
    shift = 128 if precision == "binary" else 0

    def packed(bits: Column) -> Column:
        n_bytes = F.ceil(F.size(bits) / 8).cast("int")
        byte = lambda b: F.aggregate(
            F.sequence(F.lit(0), F.lit(7)),
            F.lit(0),
            lambda acc, i: acc * 2 + F.coalesce(F.get(bits, b * 8 + i), F.lit(0)),
        )
        return F.transform(F.sequence(F.lit(0), n_bytes - 1), lambda b: byte(b) - shift)

    return df.withColumn(col, let(F.transform(v, lambda x: (x > 0).cast("int")), packed))


def unit_norm_check(df: DataFrame, col: str = "embedding", tolerance: float = UNIT_NORM_TOLERANCE) -> DataFrame:
    """One row ``unit_norm``: are all rows finite and of length one? Empty input is not."""
    lengths = df.select(norm(col).alias("n")).agg(F.min("n").alias("shortest"), F.max("n").alias("longest"))
    return lengths.select(_near_one(F.col("shortest"), F.col("longest"), tolerance).alias("unit_norm"))


def _near_one(shortest: Column, longest: Column, tolerance: float = UNIT_NORM_TOLERANCE) -> Column:
    """Whether both extremes of the lengths are about one; NaN counts as the longest, no rows as false."""
    slack = tolerance + 1e-5
    return F.coalesce((shortest >= 1 - slack) & (longest <= 1 + slack), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dim)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.clip(np.linalg.norm(m, axis=1, keepdims=True), MIN_NORM, None)


def knn_search(
    doc_vectors: DataFrame,
    query_vectors: DataFrame,
    k: int,
    *,
    assume_normalized: bool = True,
    chunk_bytes: int = BLOCK_BYTES,
    blocks: tuple[int, int] | None = None,
) -> DataFrame:
    """Exact cosine top ``k`` as ``(qid, rank, doc_id, score)``, on a grid of blocks.

    Both sides are cut by a hash into blocks of about ``BLOCK_BYTES`` (``blocks`` sets
    their numbers, of queries and of documents). A cell of the grid is one group of a
    cogroup: a block of queries meets a block of documents and
    keeps ``k`` rows per query, at most ``FOUND_ROWS``; only these are shuffled again. Inside
    the cell, products take queries by ``chunk_bytes``. A vector travels once per
    block of the other side and never to the driver, which sees two rows of
    counts. Where all queries are one block, as usual, documents move once.
    """
    if k <= 0:
        raise ValueError(f"a ranking of {k} rows can't be made")
    length = norm("embedding")
    profile = [
        F.count(F.lit(1)).alias("n"),
        F.min(F.size("embedding")).alias("lo"),
        F.max(F.size("embedding")).alias("hi"),
        _near_one(F.min(length), F.max(length)).alias("unit"),
    ]
    q_info = query_vectors.agg(*profile).first()
    d_info = doc_vectors.agg(*profile).first()
    id_type = doc_vectors.schema["doc_id"].dataType
    q_type = query_vectors.schema["qid"].dataType
    out_schema = T.StructType(
        [T.StructField("qid", q_type), T.StructField("doc_id", id_type), T.StructField("score", T.DoubleType())]
    )
    spark = doc_vectors.sparkSession
    if q_info["n"] == 0:
        return top_k(spark.createDataFrame([], out_schema), k).select("qid", "rank", "doc_id", "score")
    if d_info["n"] < k:
        raise ValueError(f"{d_info['n']} documents can't fill a ranking of {k}")
    if {q_info["lo"], q_info["hi"], d_info["lo"], d_info["hi"]} != {q_info["lo"]}:
        raise ValueError("vectors of several widths can't be compared")
    dim = q_info["lo"]
    plain_dot = assume_normalized and d_info["unit"] and q_info["unit"]
    if blocks is None:
        row_bytes = dim * 8 + 16
        q_rows = min(max(chunk_bytes, BLOCK_BYTES) // row_bytes, FOUND_ROWS // k)
        q_blocks = max(1, -(-q_info["n"] // max(1, q_rows)))
        d_blocks = max(1, -(-d_info["n"] * row_bytes // max(chunk_bytes, BLOCK_BYTES)))
        # small inputs still give every core a cell; which cell a row is in doesn't change the result
        spare = min(spark.sparkContext.defaultParallelism // (q_blocks * d_blocks), d_info["n"] // MIN_BLOCK_ROWS)
        blocks = (q_blocks, d_blocks * max(1, spare))
    cells = _grid(query_vectors, "qid", "_q", "_d", blocks), _grid(doc_vectors, "doc_id", "_d", "_q", blocks[::-1])
    scored = cells[0].cogroup(cells[1]).applyInArrow(_cell_scorer(dim, k, plain_dot, out_schema, max(1, chunk_bytes // (dim * 8 + 16))), out_schema)
    return top_k(scored, k).select("qid", "rank", "doc_id", "score")


def _grid(vectors: DataFrame, key: str, own: str, other: str, blocks: tuple[int, int]):
    """Rows grouped by cell: each is in one block of its own side and meets all of the other's."""
    mine, others = blocks
    return (
        vectors.select(key, F.col("embedding").cast("array<double>").alias("embedding"))
        .withColumn(own, F.pmod(F.xxhash64(key, "embedding"), F.lit(mine)).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        .groupBy("_q", "_d")
    )


def _cell_scorer(dim: int, k: int, plain_dot: bool, out_schema: T.StructType, chunk_rows: int):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(out_schema)

    def score(queries: pa.Table, docs: pa.Table) -> pa.Table:
        if not queries.num_rows or not docs.num_rows:
            return arrow_schema.empty_table()
        ids = np.array(docs.column("doc_id").to_pylist())
        d, q = _matrix(docs.column("embedding"), dim), _matrix(queries.column("embedding"), dim)
        if not plain_dot:
            d, q = _unit(d), _unit(q)
        q_at, d_at, scores = [], [], []
        step = max(1, min(PRODUCT_CELLS // len(ids), chunk_rows))
        for start in range(0, len(q), step):
            for row, sim in enumerate(q[start : start + step] @ d.T, start):
                keep = keep_best(np.round(sim, 9), ids, k)
                q_at.append(np.full(len(keep), row, np.int32))
                d_at.append(keep.astype(np.int32))
                scores.append(sim[keep])
        columns = [
            queries.column("qid").take(pa.array(np.concatenate(q_at))),
            docs.column("doc_id").take(pa.array(np.concatenate(d_at))),
            pa.array(np.concatenate(scores)),
        ]
        return pa.table(columns, schema=arrow_schema)

    return score


def build_vectors(docs: DataFrame, queries: DataFrame, **encoder) -> tuple[DataFrame, DataFrame]:
    """Vectors of both collections with the same encoder settings."""
    encoded_docs = encode_texts(docs, **encoder).select("doc_id", "embedding")
    encoded_queries = encode_texts(queries, **encoder).select("qid", "embedding")
    return encoded_docs, encoded_queries
