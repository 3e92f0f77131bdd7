"""Bytes of all documents that repeat 50 bytes of an earlier one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm.repeated_spans import remove_repeats


def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op8_repeated_spans": op8_repeated_spans}
ORACLE: dict[str, str] = {}
