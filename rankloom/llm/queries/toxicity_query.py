"""Toxicity of all documents; labels only of the training folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.toxicity import fit, score


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLE: dict[str, str] = {}
