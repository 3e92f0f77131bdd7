"""Joins and set operations of the search plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.operators.classify import labelled_texts, stratified_split
from rankloom.operators.common import materialise
from rankloom.operators.dense import knn_search
from rankloom.operators.lexical import bm25_search, fit_lexical, fit_tfidf, tfidf_search
from rankloom.operators.metrics import check_judged, evaluate, mark_relevant
from rankloom.operators.rerank import pad_with_originals, pair_rerank, with_category
from rankloom.operators.submission import distinct_ranked


def _bench_run(spark, sf, k=50):
    return bm25_search(fit_lexical(fx.docs(spark, sf)), fx.benchmark_queries(spark, sf), k)


def position_join(spark, sf):
    """A run that carries document numbers instead of ids; a number without document is an error."""
    docs = fx.raw_docs(spark, sf).select(F.col("doc_id").alias("doc_ix"), F.concat(F.lit("doc-"), "doc_id").alias("doc_id"))
    run = fx.title_qrels(spark, sf).withColumnRenamed("doc_id", "doc_ix")
    joined = run.join(docs, "doc_ix", "left")
    bad = F.raise_error(F.lit("document position out of bounds"))
    return joined.select("qid", F.when(F.col("doc_id").isNull(), bad).otherwise(F.col("doc_id")).alias("doc_id"))


def attribute_lookup(spark, sf):
    rows = with_category(_bench_run(spark, sf), fx.raw_docs(spark, sf))
    return rows.select("qid", "rank", "doc_id", "category")


def judged_join(spark, sf):
    return mark_relevant(_bench_run(spark, sf), fx.benchmark_qrels(spark, sf)).select("qid", "rank", "doc_id", "is_rel")


def semi_join(spark, sf):
    """Judgments whose document carries a label."""
    return fx.title_qrels(spark, sf).join(fx.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("qid", "doc_id")


def anti_join_padding(spark, sf):
    """Keep the ten best rows that are relevant or lead the list; the others follow at score 0."""
    run = materialise(_bench_run(spark, sf))
    kept = run.where(F.col("rank") <= 10)
    return pad_with_originals(kept, run).select("qid", "rank", "doc_id", F.round("score", 6).alias("score"))


def all_pairs_scores(spark, sf):
    """Every vector against every vector, best ten per vector (the pair itself included)."""
    v = fx.vectors(spark, sf)
    run = knn_search(v, v.select(F.col("doc_id").alias("qid"), "embedding"), 10)
    return run.select("qid", "rank", "doc_id", F.round("score", 6).alias("score"))


def labelled_union(spark, sf):
    rows = labelled_texts(fx.docs(spark, sf), fx.title_queries(spark, sf))
    return rows.select("row_id", F.md5("text").alias("digest"), "label")


def result_union(spark, sf):
    """Metric tables of two methods stacked with a model column."""
    docs, q, qrels = fx.docs(spark, sf), fx.benchmark_queries(spark, sf), fx.benchmark_qrels(spark, sf)
    index = fit_lexical(docs)
    plus = evaluate(bm25_search(index, q, 20), qrels, q, [5, 20]).withColumn("model", F.lit("bm25_plus"))
    okapi = evaluate(bm25_search(index, q, 20, "okapi"), qrels, q, [5, 20]).withColumn("model", F.lit("bm25_okapi"))
    return plus.unionByName(okapi).where(F.col("model").isin("bm25_plus", "bm25_okapi")).orderBy("model", "k")


def train_val_union(spark, sf):
    rows = stratified_split(labelled_texts(fx.docs(spark, sf)))
    both = rows.where("split = 'train'").unionByName(rows.where("split = 'val'"))
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def ordered_distinct(spark, sf):
    """Conversation roles and first words as a ranked list with repeats."""
    c = fx.table(spark, sf, "conversations")
    run = c.select(F.col("conv_id").alias("qid"), (F.col("turn") + 1).alias("rank"), F.substring_index("text", " ", 1).alias("doc_id"))
    return distinct_ranked(run)


def id_set_operations(spark, sf):
    """Labelled union relevant, and relevant minus labelled."""
    labelled = fx.table(spark, sf, "labels").select("doc_id")
    relevant = fx.title_qrels(spark, sf).select("doc_id").distinct()
    union = labelled.union(relevant).distinct().withColumn("part", F.lit("union"))
    return union.unionByName(relevant.subtract(labelled).withColumn("part", F.lit("minus")))


QUERIES = {
    "j1_position_join": position_join,
    "j2_attribute_lookup": attribute_lookup,
    "j3_judged_join": judged_join,
    "j4_semi_join": semi_join,
    "j5_anti_join_padding": anti_join_padding,
    "j6_all_pairs_topk": all_pairs_scores,
    "j7_labelled_union": labelled_union,
    "j8_result_union": result_union,
    "j9_train_val_union": train_val_union,
    "j10_ordered_distinct": ordered_distinct,
    "j11_id_set_operations": id_set_operations,
}

_RUN = sp.with_(sp.DOCS, sp.BENCH, sp.BENCH_QRELS, sp.bm25("r", "bq", "50"))
SPLIT = """sx AS (
  SELECT *, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + round((n - n_test) * (0.15::DOUBLE / (1 - 0.15::DOUBLE))) THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, round(n * 0.15::DOUBLE) AS n_test FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || row_id), row_id) AS rn, count(*) OVER (PARTITION BY label) AS n FROM {src})))"""

ORACLE = {
    "j1_position_join": sp.with_(sp.RAW, sp.TITLES, sp.TITLE_QRELS) + "SELECT qid, 'doc-' || doc_id AS doc_id FROM tqr",
    "j2_attribute_lookup": _RUN + "SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, category FROM r JOIN docs USING (doc_id)",
    "j3_judged_join": _RUN + """SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id,
  CASE WHEN (qid, doc_id) IN (SELECT (qid, doc_id) FROM bqr) THEN 1 ELSE 0 END AS is_rel FROM r""",
    "j4_semi_join": sp.with_(sp.RAW, sp.TITLES, sp.TITLE_QRELS) + "SELECT qid, doc_id FROM tqr WHERE doc_id IN (SELECT doc_id FROM labels)",
    "j5_anti_join_padding": _RUN
    + "SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, round(CASE WHEN rank <= 10 THEN score ELSE 0 END, 6) AS score FROM r",
    "j6_all_pairs_topk": """SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, round(s, 6) AS score FROM (
  SELECT qid, doc_id, s, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, doc_id) AS rank FROM (
    SELECT q.vec_id AS qid, d.vec_id AS doc_id, list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS s
    FROM embeddings q CROSS JOIN embeddings d)) WHERE rank <= 10""",
    "j7_labelled_union": sp.with_(sp.DOCS, sp.TITLES) + """SELECT 'd' || doc_id AS row_id, md5(content) AS digest, category AS label FROM docs
UNION ALL SELECT 'q' || qid, md5(content), category FROM tq""",
    "j8_result_union": sp.with_(sp.DOCS, sp.BENCH, sp.BENCH_QRELS, sp.bm25("r", "bq", "20"), sp.bm25("o", "bq", "20", "okapi"))
    + f"SELECT *, 'bm25_plus' AS model FROM ({sp.metrics('r', 'bqr', 'bq', (5, 20))}) UNION ALL SELECT *, 'bm25_okapi' FROM ({sp.metrics('o', 'bqr', 'bq', (5, 20))})",
    "j9_train_val_union": sp.with_("lt AS (SELECT 'd' || doc_id AS row_id, lang AS label FROM documents)", SPLIT.format(src="lt"))
    + "SELECT label, count(*) AS n FROM sx WHERE split <> 'test' GROUP BY label",
    "j10_ordered_distinct": """SELECT qid, doc_id, CAST(row_number() OVER (PARTITION BY qid ORDER BY f) AS INTEGER) AS rank FROM (
  SELECT conv_id AS qid, split_part(text, ' ', 1) AS doc_id, min(turn) AS f FROM conversations GROUP BY ALL)""",
    "j11_id_set_operations": sp.with_(sp.RAW, sp.TITLES, sp.TITLE_QRELS)
    + """SELECT doc_id, 'union' AS part FROM (SELECT doc_id FROM labels UNION SELECT doc_id FROM tqr)
UNION ALL SELECT doc_id, 'minus' FROM (SELECT doc_id FROM tqr EXCEPT SELECT doc_id FROM labels)""",
}
