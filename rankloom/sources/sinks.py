"""Writers: prepared corpora, submissions, result tables, run metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.operators.common import materialise
from rankloom.operators.submission import verify_submission


def write_prepared(docs: DataFrame, train: DataFrame, test: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Documents and queries with their ``content``, one table each."""
    for name, df in (("docs", docs), ("queries_train", train), ("queries_test", test)):
        df.write.mode("overwrite").format(fmt).save(f"{folder}/{name}")


def write_submission(df: DataFrame, path: str, top_k: int, category: str | None = None, one_file: bool = False) -> None:
    """Compute once, check, and write as CSV with header, in one file only where asked for."""
    table = materialise(df)
    verify_submission(table, top_k, category)
    (table.coalesce(1) if one_file else table).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("query_id string, relevant_doc_ids string, category string").csv(
        path, header=True, escape='"'
    )


def write_table_csv(df: DataFrame, path: str) -> None:
    """Metric tables are a few rows per method and cutoff."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_table_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def export_by_label(submissions: DataFrame, path: str) -> DataFrame:
    """Write ``(model_label, submission columns…)`` with one folder per label; return the manifest."""
    submissions.write.mode("overwrite").partitionBy("model_label").parquet(path)
    stored = submissions.sparkSession.read.schema(submissions.schema).parquet(path)
    size = F.size(F.from_json("relevant_doc_ids", "array<string>"))
    return stored.groupBy("model_label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(size).alias("top_k")
    ).withColumn("path", F.concat(F.lit(f"{path}/model_label="), F.col("model_label")))


def append_run_metadata(
    spark: SparkSession, path: str, config: Mapping, metrics: Mapping, submission_path: str, at: datetime | None = None
) -> DataFrame:
    """Append one row of run metadata to the ``runs`` table and return that row; ``at`` is now unless given."""
    row = spark.range(1).select(
        F.lit((at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")).alias("run"),
        F.lit(json.dumps(dict(config), sort_keys=True, default=str)).alias("config"),
        F.lit(json.dumps(dict(metrics), sort_keys=True, default=str)).alias("metrics"),
        F.lit(submission_path).alias("submission_path"),
    )
    row.write.mode("append").json(path)
    return row
