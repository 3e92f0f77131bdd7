"""Near-duplicate vectors of the whole embeddings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.product_quantiser import near_duplicates


def op5_product_quantiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op5_product_quantiser": op5_product_quantiser}
ORACLE: dict[str, str] = {}
