"""Reordering of a finished run by category or by a pair scorer.

A run holds at most the candidate depth per query, so windows by ``qid`` are small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rankloom.functions.text import null_to_empty, tech_tokens, truncate_text
from rankloom.operators.common import attach_docs, join_bounded

# --- fixed values -----------------------------------------------------------
DEFAULT_BOOST = 1.5
PAIR_BATCH = 32
# ----------------------------------------------------------------------------


def with_category(run: DataFrame, docs: DataFrame) -> DataFrame:
    """Run rows with the category of their document."""
    return attach_docs(run, docs, ["category"])


def rerank_by(run: DataFrame, order: list[Column], group: tuple[str, ...] = ("qid",)) -> DataFrame:
    return run.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def hard_filter(
    run: DataFrame, predictions: DataFrame, fallback: bool = True, group: tuple[str, ...] = ("qid",)
) -> DataFrame:
    """Documents of the predicted category first, the others behind in their old order.

    ``run`` carries ``category`` (see ``with_category``), ``predictions`` is
    ``(qid, prediction)``. Scores stay as they are; ``fallback=False`` drops the rest.
    """
    matched = F.col("category").eqNullSafe(F.col("prediction"))
    rows = run.join(predictions.select("qid", "prediction"), "qid", "left").withColumn("_m", matched)
    if not fallback:
        rows = rows.where("_m")
    return rerank_by(rows, [F.col("_m").desc(), F.col("rank").asc()], group).drop("_m", "prediction")


def soft_boost(
    run: DataFrame,
    proba: DataFrame | None,
    boost: float | Column = DEFAULT_BOOST,
    group: tuple[str, ...] = ("qid",),
) -> DataFrame:
    """``score * (1 + boost * p(category))``; an unknown category counts as p = 0.

    ``proba`` is ``(qid, category, p)``; ``None`` leaves the run alone.
    """
    if proba is None:
        return run
    factor = boost if isinstance(boost, Column) else F.lit(float(boost))
    rows = run.join(proba.select("qid", "category", "p"), ["qid", "category"], "left")
    boosted = rows.withColumn("score", F.col("score") * (1 + factor * F.coalesce("p", F.lit(0.0)))).drop("p")
    return rerank_by(boosted, [F.round("score", 9).desc(), F.col("doc_id").asc()], group)


def filter_then_boost(run: DataFrame, predictions: DataFrame, proba: DataFrame, boost: float = DEFAULT_BOOST) -> DataFrame:
    """Both in a chain. The boost sorts by score again, so the filter decides only ties."""
    filtered = hard_filter(run, predictions)
    rows = filtered.withColumnRenamed("rank", "_before").join(proba.select("qid", "category", "p"), ["qid", "category"], "left")
    boosted = rows.withColumn("score", F.col("score") * (1 + boost * F.coalesce("p", F.lit(0.0)))).drop("p")
    return rerank_by(boosted, [F.round("score", 9).desc(), F.col("_before").asc()]).drop("_before")


def no_rerank(run: DataFrame) -> DataFrame:
    return run


def overlap_score(query_text: Column, doc_text: Column) -> Column:
    """Built-in pair scorer: share of the query's distinct tokens found in the document."""
    q = F.array_distinct(tech_tokens(query_text))
    return F.when(F.size(q) == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(q, tech_tokens(doc_text))) / F.size(q)
    )


def pair_rerank(
    run: DataFrame,
    queries: DataFrame,
    docs: DataFrame,
    *,
    k_in: int | None = None,
    k_out: int | None = None,
    max_doc_chars: int | None = None,
    make_predict_fn: Callable | None = None,
    batch_size: int = PAIR_BATCH,
) -> DataFrame:
    """Score the first ``k_in`` candidates as (query, document) pairs and keep ``k_out``.

    Candidates that were not kept follow in their old order with score 0, up to the
    length of the list. Documents are read whole unless ``max_doc_chars`` cuts them for a
    model with a bounded input. ``make_predict_fn`` plugs in a model that takes both texts.
    """
    head = run if k_in is None else run.where(F.col("rank") <= k_in)
    texts = attach_docs(head, docs.select("doc_id", F.col("content").alias("_doc")), ["_doc"])
    pairs = join_bounded(texts, queries.select("qid", F.col("content").alias("_query")), "qid")
    doc_text = truncate_text("_doc", max_doc_chars)
    if make_predict_fn is None:
        pairs = pairs.withColumn("score", overlap_score(F.col("_query"), doc_text))
    else:
        predict = predict_batch_udf(make_predict_fn, return_type=T.DoubleType(), batch_size=batch_size)
        pairs = pairs.withColumn("score", predict(null_to_empty("_query"), doc_text))
    scored = rerank_by(
        pairs.select("qid", "doc_id", "score"), [F.round("score", 9).desc(), F.col("doc_id").asc()]
    )
    if k_out is None:
        return scored.select("qid", "rank", "doc_id", "score")
    kept = scored.where(F.col("rank") <= k_out)
    return pad_with_originals(kept, run)


def pad_with_originals(kept: DataFrame, run: DataFrame) -> DataFrame:
    """``kept`` followed by the other rows of ``run`` in their old order, score 0."""
    rest = (
        run.join(kept.select("qid", "doc_id"), ["qid", "doc_id"], "left_anti")
        .select("qid", "doc_id", F.lit(0.0).alias("score"), F.lit(1).alias("_late"), "rank")
    )
    rows = kept.select("qid", "doc_id", "score", F.lit(0).alias("_late"), "rank").unionByName(rest)
    return rerank_by(rows, [F.col("_late").asc(), F.col("rank").asc()]).select("qid", "rank", "doc_id", "score")
