"""Quality of all documents by perplexity under trusted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.kneser_ney import quality


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op4_kneser_ney": op4_kneser_ney}
ORACLE: dict[str, str] = {}
