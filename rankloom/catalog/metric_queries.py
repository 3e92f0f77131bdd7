"""Ranking and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.catalog.fusion_queries import two_runs
from rankloom.catalog.rerank_queries import NB_PARTS, QUERY_ACCURACY, query_predictions
from rankloom.operators import metrics as me
from rankloom.operators.common import join_bounded, materialise
from rankloom.operators.lexical import bm25_search, fit_lexical
from rankloom.operators.profile import pivot_metric
from rankloom.plans import studies
from rankloom.plans.config import BOOST_FACTORS, CUTOFFS

METHODS = ("tfidf", "bm25_plus", "embeddings", "hybrid_rrf")


def _bench(spark, sf, k=20):
    q = fx.benchmark_queries(spark, sf)
    return materialise(bm25_search(fit_lexical(fx.docs(spark, sf)), q, k)), fx.benchmark_qrels(spark, sf), q


def _one_metric(name):
    def query(spark, sf):
        return me.evaluate(*_bench(spark, sf), [10]).select("k", name)
    return query


def judged_check(spark, sf):
    """Per query: is it judged, and with how many relevant documents (none is allowed)."""
    q, qrels = fx.benchmark_queries(spark, sf), fx.benchmark_qrels(spark, sf)
    me.check_judged(q, q.select("qid"))
    counts = qrels.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    return q.select("qid").join(counts, "qid", "left").select("qid", F.coalesce("n", F.lit(0)).alias("n_relevant"))


def evaluate_run(spark, sf):
    return me.evaluate(*_bench(spark, sf), [20])


def evaluate_many(spark, sf):
    return me.evaluate(*_bench(spark, sf, 100), [1, 5, 10, 20, 50, 100])


def evaluate_repeats(spark, sf):
    """A run that lists documents twice: the repeat does not count again."""
    run, qrels, q = _bench(spark, sf)
    shifted = run.withColumn("rank", F.col("rank") * 2)
    twice = shifted.unionByName(run.withColumn("rank", F.col("rank") * 2 + 1))
    return me.evaluate(twice, qrels, q, [3, 10, 20])


def _title_methods(spark, sf, k=100, methods=METHODS):
    docs = fx.docs(spark, sf)
    q = fx.title_queries(spark, sf)
    return studies.method_runs(docs, q.select("qid", "content"), k, methods), docs, q, fx.title_qrels(spark, sf)


def effect_of_k(spark, sf):
    runs, _, q, qrels = _title_methods(spark, sf)
    table = me.evaluate(runs, qrels, q, CUTOFFS, ["method"], digits=4)
    return pivot_metric(table, "k", "method", METHODS, "mrr")


def per_category(spark, sf):
    runs, _, q, qrels = _title_methods(spark, sf, 50, ("bm25_plus", "embeddings"))
    labelled = join_bounded(runs, q.select("qid", "category"), "qid", salt_by="doc_id")
    table = me.evaluate(labelled, qrels, q, [50], ["method", "category"])
    return table.drop("k")


def per_category_pivot(spark, sf):
    return pivot_metric(per_category(spark, sf), "category", "method", ("bm25_plus", "embeddings"), "recall")


def mean_score(spark, sf):
    return studies.scored(me.evaluate(*_bench(spark, sf), [5, 20], digits=None)).select("k", "score")


def composite(spark, sf):
    predictions, _ = query_predictions(spark, sf)
    q, qrels = fx.title_queries(spark, sf), fx.title_qrels(spark, sf)
    run = bm25_search(fit_lexical(fx.docs(spark, sf)), q, 50)
    table = me.evaluate_with_category(run, qrels, q, [50], q, predictions)
    return table.select("k", F.round(me.composite_score(F.col("query_category_accuracy")), 5).alias("score"))


def predictions(spark, sf):
    """True and predicted language of every title."""
    predicted, _ = query_predictions(spark, sf)
    return fx.title_queries(spark, sf).join(predicted, "qid").select(F.col("category").alias("label"), "prediction")


def source_guess(spark, sf):
    """Whole-table labels: a document's source, guessed as the source of the first document with its title."""
    d = fx.raw_docs(spark, sf).select("doc_id", "title", F.get("tags", F.lit(1)).alias("label"))
    first = d.groupBy("title").agg(F.min(F.struct("doc_id", "label"))["label"].alias("prediction"))
    return d.join(first, "title").select("label", "prediction")


def accuracy(spark, sf):
    return me.accuracy(source_guess(spark, sf))


def macro_f1(spark, sf):
    return me.macro_f1(source_guess(spark, sf))


def balanced_accuracy(spark, sf):
    return me.balanced_accuracy(source_guess(spark, sf))


def report(spark, sf):
    return me.classification_report(source_guess(spark, sf))


def report_model(spark, sf):
    return me.classification_report(predictions(spark, sf))


def category_accuracy(spark, sf):
    predicted, _ = query_predictions(spark, sf)
    return me.query_category_accuracy(fx.title_queries(spark, sf), predicted)


def confusion(spark, sf):
    return me.confusion_matrix(source_guess(spark, sf))


def confusion_listed(spark, sf):
    """A label list that leaves one language out."""
    d = fx.table(spark, sf, "documents").select(F.col("lang").alias("label"), F.when(F.col("n_chars") > 2000, F.col("lang")).otherwise("en").alias("prediction"))
    return me.confusion_matrix(d, ["de", "en", "fr"])


def joint_evaluation(spark, sf):
    predicted, _ = query_predictions(spark, sf)
    q = fx.title_queries(spark, sf)
    run = bm25_search(fit_lexical(fx.docs(spark, sf)), q, 50)
    return me.evaluate_with_category(run, fx.title_qrels(spark, sf), q, [50], q, predicted)


def _stacked(spark, sf, k=50):
    dense, sparse = two_runs(spark, sf, k)
    from rankloom.operators.fusion import stack_runs

    return stack_runs({"embeddings": dense, "bm25_plus": sparse}, "method")


def rerank_matrix(spark, sf):
    predicted, proba = query_predictions(spark, sf)
    q = fx.title_queries(spark, sf)
    runs = studies.rerank_matrix(_stacked(spark, sf), fx.docs(spark, sf), predicted, proba)
    return me.evaluate_with_category(runs, fx.title_qrels(spark, sf), q, [10], q, predicted, ["method", "rerank"])


def boost_sensitivity(spark, sf):
    _, proba = query_predictions(spark, sf)
    q = fx.title_queries(spark, sf)
    runs = studies.boost_sweep(_stacked(spark, sf), fx.docs(spark, sf), proba, BOOST_FACTORS)
    return me.evaluate(runs, fx.title_qrels(spark, sf), q, [10], ["method", "boost_factor"])


def baseline_table(spark, sf):
    runs, _, q, qrels = _title_methods(spark, sf, 20, ("tfidf", "bm25_plus", "bm25_okapi", "embeddings"))
    return me.evaluate(runs, qrels, q, [20], ["method"])


QUERIES = {
    "m1_precision_at_k": _one_metric("precision"),
    "m2_recall_at_k": _one_metric("recall"),
    "m3_mrr_at_k": _one_metric("mrr"),
    "m4_judged_check": judged_check,
    "m5_evaluate_run": evaluate_run,
    "m5_evaluate_repeats": evaluate_repeats,
    "m6_evaluate_many_k": evaluate_many,
    "m7_effect_of_k": effect_of_k,
    "m8_per_category": per_category,
    "m8_per_category_pivot": per_category_pivot,
    "m9_mean_score": mean_score,
    "m10_composite_score": composite,
    "m11_accuracy": accuracy,
    "m12_macro_f1": macro_f1,
    "m13_balanced_accuracy": balanced_accuracy,
    "m14_classification_report": report,
    "m14_classification_report_model": report_model,
    "m15_query_category_accuracy": category_accuracy,
    "m16_confusion_matrix": confusion,
    "m16_confusion_matrix_listed": confusion_listed,
    "m17_joint_evaluation": joint_evaluation,
    "m18_rerank_matrix": rerank_matrix,
    "m19_boost_sensitivity": boost_sensitivity,
    "m20_baseline_table": baseline_table,
}

_BENCH = lambda k: sp.with_(sp.DOCS, sp.BENCH, sp.BENCH_QRELS, sp.bm25("r", "bq", str(k)))
_one = lambda name: _BENCH(20) + f"SELECT k, {name} FROM ({sp.metrics('r', 'bqr', 'bq', (10,))})"
_exact = lambda x: x.replace("round(avg(p), 6)", "avg(p)").replace("round(avg(rc), 6)", "avg(rc)").replace("round(avg(rr), 6)", "avg(rr)")
_TITLE = [sp.DOCS, sp.TITLES, sp.TITLE_QRELS]
_FOUR = [
    *_TITLE, sp.tfidf("t", "tq", "100"), sp.bm25("b", "tq", "100"), sp.dense("e", "tq", "100"),
    sp.fuse("f", [("e", 3.0), ("b", 1.0)], 20, "100"),
    "al AS (" + " UNION ALL ".join(f"SELECT '{n}' AS method, qid, doc_id, rank FROM {r}" for n, r in zip(METHODS, ("t", "b", "e", "f"))) + ")",
]
_CATEGORY = [
    *_TITLE, sp.bm25("b", "tq", "50"), sp.dense("e", "tq", "50"),
    "al AS (SELECT m.*, tq.category FROM (SELECT 'bm25_plus' AS method, qid, doc_id, rank FROM b UNION ALL SELECT 'embeddings', qid, doc_id, rank FROM e) m JOIN tq USING (qid))",
]
_CATEGORY_TABLE = sp.metrics("al", "tqr", "tq", (50,), "method, category", "q.category = g.category")
_ACC = QUERY_ACCURACY
_NB50 = [*NB_PARTS, sp.bm25("b", "tq", "50")]
_GUESS = f"""{sp.RAW},
y AS (SELECT source AS label, first_value(source) OVER (PARTITION BY title ORDER BY doc_id) AS prediction FROM d0)"""
_MODEL = "y AS (SELECT category AS label, prediction FROM tq JOIN pred USING (qid))"
_SCORES = """l AS (SELECT label AS c FROM y UNION SELECT prediction FROM y),
s AS (SELECT c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS sup, count(*) FILTER (prediction = c) AS pre FROM l, y GROUP BY c),
pl AS (SELECT c AS label, CASE WHEN pre = 0 THEN 0.0 ELSE tp * 1.0 / pre END AS precision, CASE WHEN sup = 0 THEN 0.0 ELSE tp * 1.0 / sup END AS recall,
  2.0 * tp / (sup + pre) AS f1, sup AS support, tp FROM s)"""
_REPORT = """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
  SELECT label, precision, recall, f1, support FROM pl
  UNION ALL SELECT 'accuracy', sum(tp) * 1.0 / sum(support), sum(tp) * 1.0 / sum(support), sum(tp) * 1.0 / sum(support), CAST(sum(support) AS BIGINT) FROM pl
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM pl
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM pl)"""
_RANKED = "row_number() OVER (PARTITION BY {g} ORDER BY {o}) AS rank"
_MATRIX = [
    *NB_PARTS, sp.bm25("b", "tq", "50"), sp.dense("e", "tq", "50"),
    """c AS (SELECT m.*, docs.category FROM (SELECT 'bm25_plus' AS method, qid, doc_id, rank, score FROM b UNION ALL SELECT 'embeddings', qid, doc_id, rank, score FROM e) m JOIN docs USING (doc_id))""",
]

ORACLE = {
    "m1_precision_at_k": _one("precision"),
    "m2_recall_at_k": _one("recall"),
    "m3_mrr_at_k": _one("mrr"),
    "m4_judged_check": sp.with_(sp.BENCH, sp.BENCH_QRELS) + "SELECT bq.qid, count(doc_id) AS n_relevant FROM bq LEFT JOIN bqr USING (qid) GROUP BY bq.qid",
    "m5_evaluate_run": _BENCH(20) + sp.metrics("r", "bqr", "bq", (20,)),
    "m5_evaluate_repeats": sp.with_(sp.DOCS, sp.BENCH, sp.BENCH_QRELS, sp.bm25("r0", "bq", "20"),
        "r AS (SELECT qid, doc_id, rank * 2 AS rank FROM r0 UNION ALL SELECT qid, doc_id, rank * 2 + 1 FROM r0)") + sp.metrics("r", "bqr", "bq", (3, 10, 20)),
    "m6_evaluate_many_k": _BENCH(100) + sp.metrics("r", "bqr", "bq", (1, 5, 10, 20, 50, 100)),
    "m7_effect_of_k": sp.with_(*_FOUR) + "SELECT k, " + ", ".join(f"round(max(mrr) FILTER (method = '{m}'), 4) AS {m}" for m in METHODS)
    + f" FROM ({_exact(sp.metrics('al', 'tqr', 'tq', CUTOFFS, 'method'))}) GROUP BY k",
    "m8_per_category": sp.with_(*_CATEGORY) + f"SELECT method, category, precision, recall, mrr FROM ({_CATEGORY_TABLE})",
    "m8_per_category_pivot": sp.with_(*_CATEGORY)
    + f"SELECT category, max(recall) FILTER (method = 'bm25_plus') AS bm25_plus, max(recall) FILTER (method = 'embeddings') AS embeddings FROM ({_CATEGORY_TABLE}) GROUP BY category",
    "m9_mean_score": _BENCH(20) + f"SELECT k, round((precision + recall + mrr) / 3, 6) AS score FROM ({_exact(sp.metrics('r', 'bqr', 'bq', (5, 20)))})",
    "m10_composite_score": sp.with_(*_NB50) + f"SELECT k, round((precision + recall + mrr + {_ACC}) * 0.25, 5) AS score FROM ({sp.metrics('b', 'tqr', 'tq', (50,))})",
    "m11_accuracy": sp.with_(_GUESS, _SCORES) + "SELECT round(sum(tp) * 1.0 / sum(support), 6) AS accuracy FROM pl",
    "m12_macro_f1": sp.with_(_GUESS, _SCORES) + "SELECT round(avg(f1), 6) AS macro_f1 FROM pl",
    "m13_balanced_accuracy": sp.with_(_GUESS, _SCORES) + "SELECT round(avg(recall) FILTER (support > 0), 6) AS balanced_accuracy FROM pl",
    "m14_classification_report": sp.with_(_GUESS, _SCORES) + _REPORT,
    "m14_classification_report_model": sp.with_(*NB_PARTS, _MODEL, _SCORES) + _REPORT,
    "m15_query_category_accuracy": sp.with_(*NB_PARTS) + f"SELECT {_ACC} AS query_category_accuracy",
    "m16_confusion_matrix": sp.with_(_GUESS) + """SELECT a.label, b.label AS prediction, (SELECT count(*) FROM y WHERE y.label = a.label AND y.prediction = b.label) AS n
FROM (SELECT DISTINCT label FROM y) a CROSS JOIN (SELECT DISTINCT label FROM y) b""",
    "m16_confusion_matrix_listed": """WITH y AS (SELECT lang AS label, CASE WHEN n_chars > 2000 THEN lang ELSE 'en' END AS prediction FROM documents),
ls AS (SELECT unnest(['de', 'en', 'fr']) AS label)
SELECT a.label, b.label AS prediction, (SELECT count(*) FROM y WHERE y.label = a.label AND y.prediction = b.label) AS n FROM ls a CROSS JOIN ls b""",
    "m17_joint_evaluation": sp.with_(*_NB50) + f"SELECT *, {_ACC} AS query_category_accuracy FROM ({sp.metrics('b', 'tqr', 'tq', (50,))})",
    "m18_rerank_matrix": sp.with_(*_MATRIX, f"""al AS (
  SELECT method, 'no_rerank' AS rerank, qid, doc_id, rank FROM c
  UNION ALL SELECT method, 'hard_filter', qid, doc_id, {_RANKED.format(g='method, qid', o='(c.category = prediction) DESC, c.rank')} FROM c JOIN pred USING (qid)
  UNION ALL SELECT method, 'soft_boost', qid, doc_id, {_RANKED.format(g='method, qid', o='round(score * (1 + 1.5 * coalesce(p, 0)), 9) DESC, doc_id')} FROM c LEFT JOIN prob USING (qid, category))""")
    + f"SELECT *, {_ACC} AS query_category_accuracy FROM ({sp.metrics('al', 'tqr', 'tq', (10,), 'method, rerank')})",
    "m19_boost_sensitivity": sp.with_(*_MATRIX, f"""al AS (
  SELECT method, boost_factor, qid, doc_id, {_RANKED.format(g='method, boost_factor, qid', o='round(score * (1 + boost_factor * coalesce(p, 0)), 9) DESC, doc_id')}
  FROM c LEFT JOIN prob USING (qid, category) CROSS JOIN (SELECT unnest([{', '.join(str(f) for f in BOOST_FACTORS)}])::DOUBLE AS boost_factor))""")
    + sp.metrics("al", "tqr", "tq", (10,), "method, boost_factor"),
    "m20_baseline_table": sp.with_(*_TITLE, sp.tfidf("t", "tq", "20"), sp.bm25("b", "tq", "20"), sp.bm25("o", "tq", "20", "okapi"), sp.dense("e", "tq", "20"),
        "al AS (" + " UNION ALL ".join(f"SELECT '{n}' AS method, qid, doc_id, rank FROM {r}" for n, r in (("tfidf", "t"), ("bm25_plus", "b"), ("bm25_okapi", "o"), ("embeddings", "e"))) + ")")
    + sp.metrics("al", "tqr", "tq", (20,), "method"),
}
