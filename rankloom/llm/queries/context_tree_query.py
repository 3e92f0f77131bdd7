"""Language-model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.context_tree import score_texts


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_context_tree": op10_context_tree}
ORACLE: dict[str, str] = {}
