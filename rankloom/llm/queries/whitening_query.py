"""Whitened components of the whole embeddings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm.whitening import whiten


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=8)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLE: dict[str, str] = {}
