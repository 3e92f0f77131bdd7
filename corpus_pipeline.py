"""Corpus pipeline: toxicity, near copies, decontamination, personal data, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``. Rows with a null id are never dropped by a stage's decision on another id;
null and empty texts pass through (they are neither toxic nor copies nor contaminated) and have no
token ids. Empty tables give empty tables. Rows that repeat an id share its decision.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm import byte_bpe, decontaminate, jaccard_join, pii, toxicity
from rankloom.llm.tables import join_by, stored

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _same_columns(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """``kept`` with the columns of ``docs``, whatever they are called."""
    return kept.select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects (score 0.5 or more)."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rejected = stored(toxicity.score(docs, model).where("predicted = 1").select("doc_id").distinct(), "rejected")
    return _same_columns(join_by(docs, rejected, ["doc_id"], "left_anti"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    groups = jaccard_join.jaccard_components(docs, n=5, percent=80)
    copies = stored(groups.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return _same_columns(join_by(docs, copies, ["doc_id"], "left_anti"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = stored(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    return _same_columns(join_by(docs, hit, ["doc_id"], "left_anti"), docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and ``n_chars`` of the texts as they are then."""
    clean = pii.sanitise(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return _same_columns(clean, docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every document."""
    both = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", remove_personal_data),
    ("token_ids", encode_tokens),
]

#: pre-tokenisation, merges and learned weights can't be written in SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
