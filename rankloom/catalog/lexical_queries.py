"""Sparse retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.operators import lexical as lx
from rankloom.session import scratch_path


def out(run):
    return run.select("qid", "rank", "doc_id", F.round("score", 6).alias("score"))


def tfidf_index(spark, sf):
    """Norm and number of terms of every document vector."""
    w = lx.document_weights(lx.fit_tfidf(fx.docs(spark, sf)))
    return w.groupBy("doc_id").agg(F.round(F.sqrt(F.sum(F.col("w") * F.col("w"))), 6).alias("norm"), F.count(F.lit(1)).alias("n_terms"))


def tfidf_topk(spark, sf):
    return out(lx.tfidf_search(lx.fit_tfidf(fx.docs(spark, sf)), fx.benchmark_queries(spark, sf), 100))


def _stats(spark, sf):
    return lx.term_stats(lx.fit_lexical(fx.docs(spark, sf)).all_postings())


def okapi_index(spark, sf):
    stats = _stats(spark, sf)
    n = lx.collection_stats(stats)["n_docs"]
    raw = F.ln(n - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    idf = F.when(raw < 0, lx._okapi_floor(stats, n)).otherwise(raw)
    return stats.where(F.col("term") != lx.LENGTH_ROW).select("term", "df", F.round(idf, 6).alias("idf"))


def plus_index(spark, sf):
    stats = _stats(spark, sf)
    c = lx.collection_stats(stats)
    return stats.where(F.col("term") != lx.LENGTH_ROW).select(
        "term", "df", "cf", F.round(F.ln((c["n_docs"] + 1) / F.col("df")), 6).alias("idf"), F.round(c["avgdl"], 6).alias("avgdl")
    )


def bm25_plus_topk(spark, sf):
    return out(lx.bm25_search(lx.fit_lexical(fx.docs(spark, sf)), fx.benchmark_queries(spark, sf), 100))


def bm25_okapi_topk(spark, sf):
    return out(lx.bm25_search(lx.fit_lexical(fx.docs(spark, sf)), fx.benchmark_queries(spark, sf), 100, "okapi"))


def bm25_stored_index(spark, sf):
    """The same search on postings written to and read from the index table."""
    docs = fx.docs(spark, sf)
    path = scratch_path(spark, "index")
    lx.write_index(lx.fit_lexical(docs), path, buckets=16)
    return out(lx.bm25_search(lx.open_index(spark, path, docs, buckets=16), fx.title_queries(spark, sf), 10))


def exact_k_padding(spark, sf):
    """The rarest titles match few documents by their tags only: queries made of sources."""
    q = (
        fx.table(spark, sf, "documents").groupBy("source").agg(F.min("doc_id").alias("qid"))
        .select("qid", F.col("source").alias("content"))
    )
    return out(lx.bm25_search(lx.fit_lexical(fx.docs(spark, sf)), q, 100))


QUERIES = {
    "r1_tfidf_index": tfidf_index,
    "r2_tfidf_topk": tfidf_topk,
    "r3_okapi_index": okapi_index,
    "r4_plus_index": plus_index,
    "r5_bm25_plus_topk": bm25_plus_topk,
    "r5_bm25_okapi_topk": bm25_okapi_topk,
    "r5_bm25_stored_index": bm25_stored_index,
    "r6_exact_k_padding": exact_k_padding,
}

_INDEX = f"""t AS (SELECT doc_id, {sp.tech('content')} AS ts FROM docs),
c AS (SELECT count(*) AS n, avg(len(ts)) AS avgdl FROM t),
p AS MATERIALIZED (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf
  FROM (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM t) GROUP BY ALL) GROUP BY term),
r AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM p, c)"""

ORACLE = {
    "r1_tfidf_index": sp.with_(sp.DOCS, sp.BENCH, sp.tfidf("x", "bq", "1"))
    + "SELECT doc_id, round(sqrt(sum(w * w)), 6) AS norm, count(*) AS n_terms FROM x_w GROUP BY doc_id",
    "r2_tfidf_topk": sp.with_(sp.DOCS, sp.BENCH, sp.tfidf("x", "bq", "100")) + sp.run_out("x"),
    "r3_okapi_index": sp.with_(sp.DOCS, _INDEX)
    + "SELECT term, df, round(CASE WHEN raw < 0 THEN 0.25 * mean ELSE raw END, 6) AS idf FROM r, (SELECT avg(raw) AS mean FROM r) m",
    "r4_plus_index": sp.with_(sp.DOCS, _INDEX)
    + "SELECT term, df, cf, round(ln((n + 1.0) / df), 6) AS idf, round(avgdl, 6) AS avgdl FROM p, c",
    "r5_bm25_plus_topk": sp.with_(sp.DOCS, sp.BENCH, sp.bm25("x", "bq", "100")) + sp.run_out("x"),
    "r5_bm25_okapi_topk": sp.with_(sp.DOCS, sp.BENCH, sp.bm25("x", "bq", "100", "okapi")) + sp.run_out("x"),
    "r5_bm25_stored_index": sp.with_(sp.DOCS, sp.TITLES, sp.bm25("x", "tq", "10")) + sp.run_out("x"),
    "r6_exact_k_padding": sp.with_(
        sp.DOCS, "sq AS (SELECT min(doc_id) AS qid, source AS content FROM documents GROUP BY source)", sp.bm25("x", "sq", "100")
    ) + sp.run_out("x"),
}
