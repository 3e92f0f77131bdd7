"""Subsets, samples, and checks on content quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.functions.text import REPLACEMENT_CHAR, default_category, word_count
from rankloom.operators.common import top_per_group

MIN_WORDS = 3


def head(df: DataFrame, n: int | None, id_col: str = "doc_id") -> DataFrame:
    """First ``n`` rows by id; ``None`` keeps all."""
    if n is None:
        return df
    if n <= 0:
        raise ValueError("the row limit must be positive")
    return df.orderBy(id_col).limit(n)


def relevant_first_subset(docs: DataFrame, qrels: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """All judged-relevant documents, filled up with the smallest other ids to ``n``.

    Also returns the judgments restricted to the subset.
    """
    relevant = docs.join(qrels.select("doc_id").distinct(), "doc_id", "left_semi")
    others = docs.join(qrels.select("doc_id").distinct(), "doc_id", "left_anti")
    room = max(n - relevant.count(), 0)
    subset = relevant.unionByName(others.orderBy("doc_id").limit(room)) if room else relevant
    return subset, qrels.join(subset.select("doc_id"), "doc_id", "left_semi").select("qid", "doc_id")


def balanced_subset(docs: DataFrame, n: int) -> DataFrame:
    """``max(1, n // categories)`` documents per category by id, topped up by id to ``n``."""
    rows = docs.withColumn("category", default_category("category"))
    n_categories = rows.select("category").distinct().count()
    per_category = max(1, n // max(1, n_categories))
    first = top_per_group(rows, ["category"], [F.col("doc_id").asc()], per_category, spread_by=["doc_id"])
    chosen = first.drop("rank")
    room = n - chosen.count()
    if room <= 0:
        # more categories than rows: categories in name order win
        return first.orderBy("category", "rank").limit(n).drop("rank")
    rest = rows.join(chosen.select("doc_id"), "doc_id", "left_anti").orderBy("doc_id").limit(room)
    return chosen.unionByName(rest)


def seeded_sample(df: DataFrame, n: int, seed: int, id_col: str = "qid") -> DataFrame:
    """Exactly ``n`` rows, the same for the same seed, whatever the partitioning."""
    if n <= 0:
        raise ValueError("the sample size must be positive")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return df.orderBy(key, F.col(id_col)).limit(n)


def evaluable_queries(queries: DataFrame, qrels: DataFrame, docs: DataFrame) -> DataFrame:
    """Queries with at least one relevant document that exists; none left is an error."""
    alive = qrels.join(docs.select("doc_id"), "doc_id", "left_semi").select("qid")
    kept = queries.join(alive, "qid", "left_semi")
    if kept.isEmpty():
        raise ValueError("no queries are left after filtering")
    return kept


def valid_cutoffs(k_values: Sequence[int], docs: DataFrame) -> DataFrame:
    """The cutoffs that the collection is large enough for, as one column ``k``."""
    if not k_values:
        raise ValueError("no cutoff values given")
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).select("n")
    kept = n_docs.select(F.explode(F.filter(F.array(*[F.lit(k) for k in k_values]), lambda k: k <= F.col("n"))).alias("k"))
    return kept


def content_quality(collections: Mapping[str, DataFrame]) -> DataFrame:
    """Anomaly counts of the ``content`` column, one row per named collection."""
    out = None
    for name, df in collections.items():
        c = F.col("content")
        words = word_count("content")
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(c.isNull()).alias("is_null"),
            F.count_if(c.isNotNull() & (words == 0)).alias("is_empty"),
            F.count_if((words > 0) & (words < MIN_WORDS)).alias("too_short"),
            F.count_if(F.contains(c, F.lit(REPLACEMENT_CHAR))).alias("bad_encoding"),
            (F.count(F.lit(1)) - F.count_distinct(F.sha2(c, 256))).alias("duplicates"),
        ).select(F.lit(name).alias("collection"), "*")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("critical", F.col("is_null") + F.col("is_empty") + F.col("too_short") + F.col("bad_encoding"))


def require_clean_content(report: DataFrame) -> None:
    """Blocking form of ``content_quality``."""
    critical = report.agg(F.sum("critical").alias("n")).first()["n"] or 0
    if critical:
        raise ValueError(f"{critical} anomalies in the content column")


def locate_bad_characters(df: DataFrame, marker: str = REPLACEMENT_CHAR, id_col: str = "doc_id") -> DataFrame:
    """Rows that hold the marker, with a flag per field."""
    has = lambda c: F.coalesce(F.contains(c, F.lit(marker)), F.lit(False))
    flags = df.select(
        id_col,
        has(F.col("title")).alias("in_title"),
        has(F.col("text")).alias("in_text"),
        F.coalesce(F.exists("tags", lambda t: has(t)), F.lit(False)).alias("in_tags"),
    )
    return flags.where(F.col("in_title") | F.col("in_text") | F.col("in_tags"))
