"""Reranking by predicted category and by pair scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.catalog.lexical_queries import out
from rankloom.operators import rerank as rk
from rankloom.operators.classify import fit_features, fit_naive_bayes, labelled_texts
from rankloom.operators.common import materialise
from rankloom.operators.lexical import bm25_search, fit_lexical


def query_predictions(spark, sf):
    """Language of every title by Naive Bayes on all documents: predictions and probabilities."""
    train = labelled_texts(fx.docs(spark, sf))
    target = fx.title_queries(spark, sf).select(F.col("qid").alias("row_id"), F.col("content").alias("text"))
    model = fit_features(train)
    nb = fit_naive_bayes(model.class_sums(), train.select("row_id", "label"), model.vocabulary)
    votes = materialise(nb.votes(model, target))
    predictions = materialise(nb.predict(votes, target).withColumnRenamed("row_id", "qid"))
    proba = materialise(nb.probabilities(votes, target).withColumnRenamed("row_id", "qid"))
    return predictions, proba


def categorised_run(spark, sf, k=50):
    docs = fx.docs(spark, sf)
    run = bm25_search(fit_lexical(docs), fx.title_queries(spark, sf), k)
    return materialise(rk.with_category(run, docs))


def hard_filter(spark, sf):
    predictions, _ = query_predictions(spark, sf)
    return out(rk.hard_filter(categorised_run(spark, sf), predictions))


def hard_filter_only_matches(spark, sf):
    predictions, _ = query_predictions(spark, sf)
    return out(rk.hard_filter(categorised_run(spark, sf), predictions, fallback=False))


def soft_boost(spark, sf):
    _, proba = query_predictions(spark, sf)
    return out(rk.soft_boost(categorised_run(spark, sf), proba))


def soft_boost_negative(spark, sf):
    _, proba = query_predictions(spark, sf)
    return out(rk.soft_boost(categorised_run(spark, sf), proba, -2.0))


def chained(spark, sf):
    predictions, proba = query_predictions(spark, sf)
    return out(rk.filter_then_boost(categorised_run(spark, sf), predictions, proba))


def pair_scores(spark, sf):
    docs = fx.docs(spark, sf)
    q = fx.title_queries(spark, sf)
    run = materialise(bm25_search(fit_lexical(docs), q, 50))
    return out(rk.pair_rerank(run, q, docs, k_in=30, k_out=20))


def length_difference():
    """A plugged pair scorer on both texts."""

    def predict(queries: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return np.array([-abs(len(a) - len(b)) for a, b in zip(queries, docs)], dtype=np.float64)

    return predict


def plugged_pair_scorer(spark, sf):
    docs = fx.docs(spark, sf)
    q = fx.title_queries(spark, sf)
    run = materialise(bm25_search(fit_lexical(docs), q, 20))
    return out(rk.pair_rerank(run, q, docs, max_doc_chars=None, make_predict_fn=length_difference))


def untouched(spark, sf):
    return out(rk.no_rerank(categorised_run(spark, sf)))


QUERIES = {
    "k1_hard_filter": hard_filter,
    "k1_hard_filter_only_matches": hard_filter_only_matches,
    "k2_soft_boost": soft_boost,
    "k2_soft_boost_negative": soft_boost_negative,
    "k3_filter_then_boost": chained,
    "k4_pair_rerank": pair_scores,
    "k4_plugged_pair_scorer": plugged_pair_scorer,
    "k5_no_rerank": untouched,
}

NB_PARTS = [
    sp.DOCS,
    sp.TITLES,
    sp.TITLE_QRELS,
    "tr AS (SELECT 'd' || doc_id AS row_id, content AS text, category AS label FROM docs)",
    "tt AS (SELECT qid AS row_id, content AS text FROM tq)",
    # training rows and targets share the key type
    "trs AS (SELECT row_id, text, label FROM tr)",
    "tts AS (SELECT CAST(row_id AS VARCHAR) AS row_id, text FROM tt)",
    sp.naive_bayes("nb", "trs", "tts"),
    "pred AS (SELECT CAST(row_id AS BIGINT) AS qid, prediction FROM nb_y)",
    "prob AS (SELECT CAST(row_id AS BIGINT) AS qid, category, p FROM nb_p)",
]
QUERY_ACCURACY = "(SELECT round(avg(CASE WHEN category = prediction THEN 1.0 ELSE 0.0 END), 6) FROM tq JOIN pred USING (qid))"
_RUN = [*NB_PARTS, sp.bm25("b", "tq", "50"), "c AS (SELECT b.*, docs.category FROM b JOIN docs USING (doc_id))"]
_RANKED = "SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY {order}) AS INTEGER) AS rank, doc_id, round({score}, 6) AS score FROM ({src})"
_FILTER = "SELECT c.*, c.category = prediction AS m FROM c JOIN pred USING (qid)"
_BOOST = "SELECT c.*, score * (1 + {f} * coalesce(p, 0)) AS s FROM c LEFT JOIN prob USING (qid, category)"
_PAIR = [sp.RAW, sp.DOCS.replace(sp.RAW + ",\n", ""), sp.TITLES]


def _overlap(q: str, d: str) -> str:
    return f"CASE WHEN len({q}) = 0 THEN 0.0 ELSE len(list_intersect(list_distinct({q}), {d})) * 1.0 / len(list_distinct({q})) END"


ORACLE = {
    "k1_hard_filter": sp.with_(*_RUN) + _RANKED.format(order="m DESC, rank", score="score", src=_FILTER),
    "k1_hard_filter_only_matches": sp.with_(*_RUN) + _RANKED.format(order="rank", score="score", src=_FILTER + " WHERE c.category = prediction"),
    "k2_soft_boost": sp.with_(*_RUN) + _RANKED.format(order="round(s, 9) DESC, doc_id", score="s", src=_BOOST.format(f=1.5)),
    "k2_soft_boost_negative": sp.with_(*_RUN) + _RANKED.format(order="round(s, 9) DESC, doc_id", score="s", src=_BOOST.format(f=-2.0)),
    "k3_filter_then_boost": sp.with_(
        *_RUN, f"hf AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY m DESC, rank) AS before FROM ({_FILTER}))"
    ) + _RANKED.format(
        order="round(s, 9) DESC, before", score="s",
        src="SELECT hf.*, score * (1 + 1.5 * coalesce(p, 0)) AS s FROM hf LEFT JOIN prob USING (qid, category)",
    ),
    "k4_pair_rerank": sp.with_(sp.DOCS, sp.TITLES, sp.bm25("b", "tq", "50"), f"""pr AS (
  SELECT b.qid, b.doc_id, rank, {_overlap(sp.tech('tq.content'), sp.tech('docs.content'))} AS s
  FROM b JOIN tq USING (qid) JOIN docs USING (doc_id)),
kp AS (SELECT * FROM (SELECT qid, doc_id, s, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, doc_id) AS r FROM pr WHERE rank <= 30) WHERE r <= 20),
al AS (SELECT qid, doc_id, s, 0 AS late, r FROM kp UNION ALL
  SELECT qid, doc_id, 0.0, 1, rank FROM b WHERE (qid, doc_id) NOT IN (SELECT (qid, doc_id) FROM kp))""")
    + _RANKED.format(order="late, r", score="s", src="SELECT * FROM al"),
    "k4_plugged_pair_scorer": sp.with_(sp.DOCS, sp.TITLES, sp.bm25("b", "tq", "20"), """pr AS (
  SELECT b.qid, b.doc_id, -abs(length(tq.content) - length(docs.content))::DOUBLE AS s FROM b JOIN tq USING (qid) JOIN docs USING (doc_id))""")
    + _RANKED.format(order="s DESC, doc_id", score="s", src="SELECT * FROM pr"),
    "k5_no_rerank": sp.with_(sp.DOCS, sp.TITLES, sp.bm25("b", "tq", "50")) + sp.run_out("b"),
}
