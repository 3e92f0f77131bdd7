"""Stored intermediate tables, null-safe joins by document and connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rankloom.operators.common import fits_broadcast
from rankloom.session import scratch_path

#: measured size up to which the small side of a join is broadcast
SMALL_BYTES = 24 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on the session's Arrow batches hold ``BATCH_BYTES`` at most.

    Ten thousand long texts in one batch would otherwise lie in the JVM and in the worker at once.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = df.sparkSession.conf.get(setting).rstrip("b")
    if not have.isdigit() or int(have) > BATCH_BYTES:
        df.sparkSession.conf.set(setting, str(BATCH_BYTES))
    return df


def doc_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` only: whatever other columns are called, they can't clash."""
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def join_by(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Null-safe join; ``small`` is broadcast only where its measured size allows, else both are shuffled.

    Adaptive execution splits a hot key of the shuffled form.
    """
    right = small.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in small.columns])
    if fits_broadcast(small, SMALL_BYTES):
        right = F.broadcast(right)
    condition: Column = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return big.join(right, condition, how).drop(*[f"_r_{k}" for k in keys])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (src, dst): the smallest node reachable.

    Alternates hooking and shortcutting: each node takes the smallest label among its
    neighbours, then the label of its label, until no label falls. Labels of stars
    settle in two rounds and paths in about the logarithm of their length. A hub's
    edges are aggregated before the shuffle; every round is stored.
    """
    both = stored(
        edges.select("src", "dst").where("src <> dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")).where("src <> dst")).distinct(),
        "edges",
    )
    labels = stored(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("node")).alias("component")), "labels")
    while True:
        there = labels.select(F.col("node").alias("dst"), F.col("component").alias("_c"))
        lowest = join_by(both, there, ["dst"], "inner").groupBy(F.col("src").alias("node")).agg(F.min("_c").alias("_n"))
        hooked = join_by(labels, lowest, ["node"], "inner").select("node", F.least("component", "_n").alias("component"), F.col("component").alias("_old"))
        # the old label's node hears of the new label too, so that whole trees move
        told = hooked.groupBy(F.col("_old").alias("node")).agg(F.min("component").alias("_t"))
        hooked = join_by(hooked, told, ["node"], "left").select("node", F.least("component", F.coalesce("_t", "component")).alias("component"), "_old")
        hooked = stored(hooked, "hooked")
        jump = hooked.select(F.col("node").alias("component"), F.col("component").alias("_j"))
        nxt = join_by(hooked, jump, ["component"], "left").select("node", F.least("component", F.coalesce("_j", "component")).alias("component"), "_old")
        nxt = stored(nxt, "labels")
        moved = nxt.where(F.col("component") != F.col("_old")).limit(1).count()
        labels = nxt.select("node", "component")
        if not moved:
            return labels


def bloom_words(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bloom filter (one hash) over a column of 64-bit hashes, as ``bits / 64`` words.

    Built by an aggregate; at most ``bits / 64`` rows of 12 bytes reach the driver however many
    hashes there are, and the filter that tasks receive has ``bits / 8`` bytes.
    """
    bit = F.col(column).bitwiseAND(bits - 1)
    words = (
        hashes.select(F.shiftright(bit, 6).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .collect()
    )
    out = np.zeros(bits // 64, dtype=np.uint64)
    if words:
        out[[r["w"] for r in words]] = np.array([r["b"] for r in words], dtype=np.int64).view(np.uint64)
    return out


def in_bloom(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = hashes & np.uint64(len(bloom) * 64 - 1)
    return (bloom[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) == 1
