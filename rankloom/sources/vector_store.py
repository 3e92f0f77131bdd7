"""Incremental embedding: every text is encoded once per encoder setting.

The store is a folder of data folders, each bucketed by key, and a manifest (``sources.manifest``) whose newest
version names the data folders that count. An update looks its keys up in the buckets they fall into, encodes
the misses into a data folder of its own and commits. A writer who finds the version taken looks only for keys
that the other one added, leaves these out and commits again, so a key is never there twice.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankloom.operators.common import join_bounded, materialise
from rankloom.operators.dense import encode_texts
from rankloom.sources import manifest

BUCKETS = 64
_SCHEMA = "key string, embedding array<double>, bucket int"


def encoder_tag(**settings) -> str:
    """Stable text for the settings that change a vector."""
    return "|".join(f"{k}={settings[k]}" for k in sorted(settings))


def with_key(df: DataFrame, tag: str, text_col: str = "content") -> DataFrame:
    """Content key: SHA-256 over encoder settings and text."""
    return df.withColumn("key", F.sha2(F.concat_ws(":", F.lit(tag), F.coalesce(F.col(text_col), F.lit(""))), 256))


def missing_rows(keyed: DataFrame, store: DataFrame) -> DataFrame:
    """Rows whose key the store does not hold yet."""
    return keyed.join(store.select("key"), "key", "left_anti")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def _newest(spark: SparkSession, path: str) -> tuple[int, dict]:
    have = manifest.versions(spark, path)
    return (have[-1], manifest.read_version(spark, path, have[-1])) if have else (-1, {"buckets": BUCKETS, "folders": []})


def _read(spark: SparkSession, path: str, folders: list[str], buckets: list[int] | None = None) -> DataFrame:
    parts = [spark.read.schema(_SCHEMA).parquet(f"{path}/data/{name}") for name in folders]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _SCHEMA)
    return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))


def read_store(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """``(key, embedding)`` of the newest version; with ``keys`` only the buckets these fall into are opened."""
    _, state = _newest(spark, path)
    return _read(spark, path, state["folders"], None if keys is None else _touched(keys, state["buckets"])).drop("bucket")


def _touched(keyed: DataFrame, buckets: int) -> list[int]:
    """Buckets of the keys: as many numbers as there are buckets at most."""
    return [r[0] for r in keyed.select(_bucket(buckets).alias("b")).distinct().collect()]


def _write(spark: SparkSession, path: str, rows: DataFrame, buckets: int) -> str:
    name = uuid.uuid4().hex
    kept = rows.select("key", F.col("embedding").cast("array<double>").alias("embedding")).withColumn("bucket", _bucket(buckets))
    kept.repartition("bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(f"{path}/data/{name}")
    return name


def add_vectors(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """Commit stored ``rows(key, embedding)``, distinct keys the caller found missing; the version they are in.

    Keys that another writer commits first are left to it.
    """
    version, state = _newest(spark, path)
    seen = state["folders"]
    name = _write(spark, path, rows, state["buckets"])
    while True:
        version, state = _newest(spark, path)
        others = [f for f in state["folders"] if f not in seen]
        if others:
            mine = _read(spark, path, [name])
            theirs = _read(spark, path, others, _touched(mine, state["buckets"])).select("key")
            name = _write(spark, path, mine.join(theirs, "key", "left_anti"), state["buckets"])
            seen = state["folders"]
        try:
            manifest.commit(spark, path, version + 1, {**state, "folders": [*state["folders"], name]})
            return version + 1
        except manifest.VersionTaken:
            continue


def compact(spark: SparkSession, path: str) -> int:
    """Commit a version whose vectors lie in one data folder, as many updates leave many."""
    version, state = _newest(spark, path)
    name = _write(spark, path, _read(spark, path, state["folders"]), state["buckets"])
    manifest.commit(spark, path, version + 1, {**state, "folders": [name]})
    return version + 1


def update_store(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    text_col: str = "content",
    *,
    id_col: str = "doc_id",
    model: str | None = None,
    **encoder,
) -> DataFrame:
    """Encode the misses, add them to the store, return ``(id, embedding)`` for all rows.

    ``model`` names a plugged model and is part of the key, so models can share a store.
    """
    if encoder.get("make_predict_fn") is not None and not model:
        raise ValueError("a plugged model needs a name: its vectors are stored under it")
    settings = {k: v for k, v in encoder.items() if k not in ("make_predict_fn", "batch_size")}
    settings["model"] = model or "built-in"
    keyed = with_key(df.select(id_col, text_col), encoder_tag(**settings), text_col)
    # the keys are what both look-ups need; the texts are read again only for misses
    keys = materialise(keyed.select(id_col, "key"))
    missing = materialise(missing_rows(keys.select("key").distinct(), read_store(spark, path, keys)))
    if not missing.isEmpty():
        fresh = join_bounded(keyed, missing, "key", "left_semi").dropDuplicates(["key"]).select("key", text_col)
        add_vectors(spark, path, encode_texts(fresh, text_col, **encoder).select("key", "embedding"))
    return keys.join(read_store(spark, path, keys), "key").select(id_col, "embedding")
