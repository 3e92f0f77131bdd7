"""Byte-level BPE round trip over all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm.byte_bpe import decode, encode

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = decode(encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
ORACLE: dict[str, str] = {}
