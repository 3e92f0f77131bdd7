"""All conversations, damaged by a hash and repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.conversation_repair import damage, repair_report


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
ORACLE: dict[str, str] = {}
