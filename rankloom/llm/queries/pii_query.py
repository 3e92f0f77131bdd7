"""Personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm.pii import find_spans


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    terms = F.array_join(F.transform("terms", lambda t: F.concat_ws(":", F.lit("term"), t["s"].cast("string"), t["e"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *[f"n_{k}" for k in ("email", "ip", "card", "phone")],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.size("terms") > 0, terms)).alias("spans"),
    )


QUERIES = {"op2_pii": op2_pii}
ORACLE: dict[str, str] = {}
