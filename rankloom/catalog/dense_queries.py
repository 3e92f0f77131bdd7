"""Dense retrieval."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.catalog.lexical_queries import out
from rankloom.functions.vectors import norm, truncate_dims
from rankloom.operators import dense as de
from rankloom.operators.common import materialise


def long_vectors(df, key):
    return df.select(key, F.posexplode("embedding").alias("i", "v")).select(
        key, "i", F.round("v", 6).alias("v")
    )


def encode_hash(spark, sf):
    return long_vectors(de.encode_texts(fx.benchmark_queries(spark, sf)), "qid")


def length_features():
    """A plugged model: text length and vowel share, loaded once per Python worker."""

    def predict(texts: np.ndarray) -> np.ndarray:
        rows = [[float(len(t)), float(sum(c in "aeiou" for c in t)), 1.0] for t in texts]
        return np.array(rows, dtype=np.float32)

    return predict


def encode_plugged(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    vec = de.encode_texts(docs, make_predict_fn=length_features, normalize=False)
    return vec.select(
        "doc_id",
        F.get("embedding", F.lit(0)).cast("bigint").alias("n_chars"),
        F.get("embedding", F.lit(1)).cast("bigint").alias("n_vowels"),
    )


def normalise(spark, sf):
    scaled = fx.vectors(spark, sf).withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") * 3 + 1))
    return long_vectors(de.l2_normalize(scaled), "doc_id")


def truncate(spark, sf):
    cut = fx.vectors(spark, sf).withColumn("embedding", truncate_dims("embedding", 48))
    return long_vectors(de.l2_normalize(cut), "doc_id")


def _quantised(precision):
    def query(spark, sf):
        q = de.quantize(fx.vectors(spark, sf), precision)
        return q.select("doc_id", F.array_join(F.transform("embedding", lambda x: x.cast("string")), ",").alias("codes"))
    return query


def build_vectors(spark, sf):
    docs, queries = de.build_vectors(fx.docs(spark, sf), fx.benchmark_queries(spark, sf))
    both = docs.select(F.concat(F.lit("d"), "doc_id").alias("id"), "embedding").unionByName(
        queries.select(F.concat(F.lit("q"), "qid").alias("id"), "embedding")
    )
    first = F.get("embedding", F.lit(0))
    return both.select("id", F.size("embedding").alias("dim"), F.round(norm("embedding"), 6).alias("norm"), F.round(first, 6).alias("first"))


def unit_norm(spark, sf):
    return de.unit_norm_check(fx.vectors(spark, sf))


def knn(spark, sf):
    """All documents' hash vectors against every title."""
    docs, queries = map(materialise, de.build_vectors(fx.docs(spark, sf), fx.title_queries(spark, sf)))
    return out(de.knn_search(docs, queries, 100))


def knn_cosine(spark, sf):
    """Vectors that are not of length one take the full cosine."""
    v = fx.vectors(spark, sf).withColumn("embedding", F.transform("embedding", lambda x: x * 5))
    return out(de.knn_search(v, v.select(F.col("doc_id").alias("qid"), "embedding"), 10))


def knn_blocks(spark, sf):
    """The same search with queries in many small blocks."""
    v = fx.vectors(spark, sf)
    q = v.select(F.col("doc_id").alias("qid"), "embedding")
    return out(de.knn_search(v, q, 10, chunk_bytes=1 << 17))


QUERIES = {
    "d1_encode_hash": encode_hash,
    "d1_encode_plugged_model": encode_plugged,
    "d2_normalise": normalise,
    "d3_truncate_dims": truncate,
    "d4_quantise_int8": _quantised("int8"),
    "d4_quantise_uint8": _quantised("uint8"),
    "d4_quantise_binary": _quantised("binary"),
    "d4_quantise_ubinary": _quantised("ubinary"),
    "d5_build_vectors": build_vectors,
    "d6_unit_norm_check": unit_norm,
    "d7_knn_topk": knn,
    "d7_knn_cosine": knn_cosine,
    "d7_knn_query_blocks": knn_blocks,
}


def _long(x: str, dims: int = 64) -> str:
    return f"SELECT doc_id, i - 1 AS i, v FROM (SELECT vec_id AS doc_id, unnest({x}) AS v, generate_subscripts({x}, 1) AS i FROM embeddings) WHERE i <= {dims}"


_V = "v AS (SELECT vec_id AS doc_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"


def _scalar(shift: int) -> str:
    return sp.with_(_V, "r AS (SELECT i, min(x) AS lo, max(x) AS hi FROM v GROUP BY i)") + f"""SELECT doc_id,
  string_agg(CAST(CAST(trunc((x - lo) / ((hi - lo) / 255) - {shift}) AS INTEGER) AS VARCHAR), ',' ORDER BY i) AS codes FROM v JOIN r USING (i) GROUP BY doc_id"""


def _packed(shift: int) -> str:
    return sp.with_(_V, "b AS (SELECT doc_id, (i - 1) // 8 AS b, sum(CASE WHEN x > 0 THEN 1 << (7 - (i - 1) % 8)::INTEGER ELSE 0 END) AS n FROM v GROUP BY ALL)") + f"""SELECT doc_id,
  string_agg(CAST(n - {shift} AS VARCHAR), ',' ORDER BY b) AS codes FROM b GROUP BY doc_id"""


_SELF = """SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, round(s, 6) AS score FROM (
  SELECT qid, doc_id, s, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, doc_id) AS rank FROM (
    SELECT q.vec_id AS qid, d.vec_id AS doc_id, {sim} AS s FROM embeddings q CROSS JOIN embeddings d)) WHERE rank <= 10"""
_DOT = "list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[])"
_COS = f"{_DOT} / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) / sqrt(list_dot_product(d.embedding::DOUBLE[], d.embedding::DOUBLE[]))"

ORACLE = {
    "d1_encode_hash": sp.with_(sp.BENCH, sp.hashed("h", "bq", "qid")) + """SELECT qid, CAST(g.i AS INTEGER) AS i, round(coalesce(v, 0), 6) AS v
FROM bq CROSS JOIN (SELECT unnest(range(64)) AS i) g LEFT JOIN h USING (qid, i)""",
    "d1_encode_plugged_model": """SELECT doc_id, length(text) AS n_chars,
  CAST(length(text) - length(translate(text, 'aeiou', '')) AS BIGINT) AS n_vowels FROM documents""",
    "d2_normalise": f"""WITH v AS ({_long('embedding')}), s AS (SELECT doc_id, i, v::DOUBLE * 3 + 1 AS v FROM v)
SELECT doc_id, CAST(i AS INTEGER) AS i, round(v::DOUBLE / sqrt(sum(v::DOUBLE * v::DOUBLE) OVER (PARTITION BY doc_id)), 6) AS v FROM s""",
    "d3_truncate_dims": f"""WITH s AS ({_long('embedding', 48)})
SELECT doc_id, CAST(i AS INTEGER) AS i, round(v::DOUBLE / sqrt(sum(v::DOUBLE * v::DOUBLE) OVER (PARTITION BY doc_id)), 6) AS v FROM s""",
    "d4_quantise_int8": _scalar(128),
    "d4_quantise_uint8": _scalar(0),
    "d4_quantise_binary": _packed(128),
    "d4_quantise_ubinary": _packed(0),
    "d5_build_vectors": sp.with_(
        sp.DOCS, sp.BENCH, "al AS (SELECT 'd' || doc_id AS id, content FROM docs UNION ALL SELECT 'q' || qid, content FROM bq)", sp.hashed("h", "al", "id")
    ) + """SELECT id, CAST(64 AS INTEGER) AS dim, round(sqrt(coalesce(sum(v * v), 0)), 6) AS norm,
  round(coalesce(max(v) FILTER (i = 0), 0), 6) AS first FROM al LEFT JOIN h USING (id) GROUP BY id""",
    "d6_unit_norm_check": "SELECT bool_and(abs(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) <= 0.02001) AS unit_norm FROM embeddings",
    "d7_knn_topk": sp.with_(sp.DOCS, sp.TITLES, sp.dense("r", "tq", "100")) + sp.run_out("r"),
    "d7_knn_cosine": _SELF.format(sim=_COS),
    "d7_knn_query_blocks": _SELF.format(sim=_DOT),
}
