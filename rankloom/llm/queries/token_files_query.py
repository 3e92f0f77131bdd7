"""Token ids of all documents, written to seekable files and read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm.token_files import read_tokens, write_tokens
from rankloom.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = write_tokens(docs, TOKENIZER, scratch_path(spark, "tokens"), end_id=END_ID)
    return read_tokens(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op9_token_files": op9_token_files}
ORACLE: dict[str, str] = {}
