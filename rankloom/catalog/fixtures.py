"""Views of the driver tables in the shape the operators expect.

* ``docs``: every document; the first line is its title, language and source are its tags.
* ``benchmark_queries``: every benchmark passage; relevant are the documents that quote it.
* ``title_queries``: every title that more than one document carries; relevant are
  the documents under that title, its category is the language of the first of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.functions.text import with_content
from rankloom.operators.common import attach_docs, join_bounded, read_parallel


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parallel(spark, f"{sf_dir}/{name}.parquet")


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    title = F.substring_index("text", "\n", 1)
    return d.select(
        "doc_id",
        title.alias("title"),
        F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("text"),
        F.array("lang", "source").alias("tags"),
        F.col("lang").alias("category"),
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_content(raw_docs(spark, sf_dir))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("content"))


def benchmark_qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a passage word for word.

    The longest inner word of a passage stands white-space delimited in any text
    that quotes the passage, so an equality join on it finds every candidate and
    ``contains`` decides.
    """
    passages = benchmark_queries(spark, sf_dir).withColumn("_w", F.split("content", r"\s+"))
    inner = F.slice("_w", F.lit(2), F.size("_w") - 2)
    longest = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    anchors = passages.select(
        "qid",
        "content",
        F.when(F.size("_w") >= 3, longest)
        .otherwise(F.raise_error(F.lit("a passage needs three words")))
        .alias("word"),
    )
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = d.select("doc_id", F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("word"))
    # a common word may be an anchor, and one document may quote many passages
    candidates = join_bounded(words, anchors, "word", salt_by="doc_id").select("qid", "doc_id", "content")
    return attach_docs(candidates, d, ["text"]).where(F.contains("text", "content")).select("qid", "doc_id")


def title_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_docs(spark, sf_dir)
        .groupBy("title")
        .agg(
            F.min("doc_id").alias("qid"),
            F.min(F.struct("doc_id", "category"))["category"].alias("category"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .select("qid", F.col("title").alias("content"), "category")
    )


def title_qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = title_queries(spark, sf_dir).select("qid", F.col("content").alias("title"))
    return raw_docs(spark, sf_dir).select("doc_id", "title").join(q, "title").select("qid", "doc_id")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
