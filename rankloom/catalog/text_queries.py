"""Projections and scalar text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.functions import text as tx
from rankloom.operators.fusion import expand_queries
from rankloom.operators.lexical import bm25_search, fit_lexical
from rankloom.operators.metrics import evaluate

LANGUAGE_EXPANSIONS = {
    "de": "deutsch sprache text der die das",
    "en": "english language text the and that",
    "fr": "langue texte le la les de",
}


def _document_text(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", "text")


def safe_text(spark, sf):
    """Page markup as dirty text, with empty URLs paths turned to null."""
    pages = fx.table(spark, sf, "pages")
    dirty = F.concat(F.lit("  "), F.col("url"), F.lit("�"), F.col("html"), F.lit("\t\n"))
    return pages.select("page_id", F.sha2(tx.safe_text(dirty), 256).alias("safe"), F.sha2(tx.safe_text(dirty, False), 256).alias("safe_old"))


def build_content(spark, sf):
    return fx.docs(spark, sf).select("doc_id", F.length("content").alias("n"), F.md5("content").alias("digest"))


def build_content_text_tags(spark, sf):
    """Bare string tags and missing titles."""
    d = fx.raw_docs(spark, sf).withColumn("title", F.nullif("title", "text"))
    content = tx.build_content(F.when(F.col("category") != "en", F.col("title")), "text", F.col("category"), tags_are_text=True)
    return d.select("doc_id", F.md5(content).alias("digest"))


def clean_text(spark, sf):
    return _document_text(spark, sf).select("doc_id", F.md5(tx.clean_text("text")).alias("digest"))


def clean_text_runs(spark, sf):
    """The pages carry the punctuation runs and markup white space."""
    return fx.table(spark, sf, "pages").select("page_id", F.md5(tx.clean_text("html")).alias("digest"))


def add_content(spark, sf):
    both = tx.with_content(fx.raw_docs(spark, sf), clean=True)
    return both.select("doc_id", F.md5("content").alias("digest"), F.size("tags").alias("n_tags"))


def truncate_text(spark, sf):
    return _document_text(spark, sf).select("doc_id", F.md5(tx.truncate_text("text", 512)).alias("digest"))


def _token_digest(name):
    def query(spark, sf):
        tokens = tx.tokenizer(name)("text")
        return _document_text(spark, sf).select(
            "doc_id", F.size(tokens).alias("n"), F.md5(F.array_join(tokens, " ")).alias("digest")
        )
    return query


def ngrams(spark, sf):
    grams = tx.ngrams("w", 1, 2)
    return _document_text(spark, sf).select("doc_id", tx.word_tokens("text").alias("w")).select(
        "doc_id", F.size(grams).alias("n"), F.md5(F.array_join(grams, "|")).alias("digest")
    )


def word_count(spark, sf):
    return _document_text(spark, sf).select("doc_id", tx.word_count("text").alias("n"))


def null_to_empty(spark, sf):
    labels = fx.table(spark, sf, "labels")
    rows = fx.table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    return rows.select("doc_id", tx.null_to_empty("quality").alias("quality_text"))


def default_category(spark, sf):
    labels = fx.table(spark, sf, "labels").select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("fine").alias("c"))
    rows = fx.table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    return rows.select("doc_id", tx.default_category("c").alias("category"))


def id_text(spark, sf):
    c = fx.table(spark, sf, "conversations")
    return c.select(tx.id_text("conv_id").alias("conv_id"), tx.id_text("turn").alias("turn"))


def model_label(spark, sf):
    d = fx.table(spark, sf, "documents")
    model = F.when(F.col("lang") == "en", "embeddings").when(F.col("lang") == "de", "bm25").otherwise("tfidf")
    return d.select("doc_id", tx.model_label(model, F.col("source"), F.col("source")).alias("model_label"))


def json_ids(spark, sf):
    per_turn = fx.table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.format_string("%05d", "turn"))).alias("ids")
    )
    back = tx.json_to_ids(tx.ids_to_json("ids"))
    return per_turn.select("conv_id", tx.ids_to_json("ids").alias("encoded"), F.size(back).alias("n"), F.element_at(back, -1).alias("last"))


def rounded_metrics(spark, sf):
    q = fx.benchmark_queries(spark, sf)
    run = bm25_search(fit_lexical(fx.docs(spark, sf)), q, 20)
    return evaluate(run, fx.benchmark_qrels(spark, sf), q, [5, 20], digits=4)


def expand(spark, sf):
    q = fx.title_queries(spark, sf).withColumnRenamed("category", "prediction")
    return expand_queries(q, LANGUAGE_EXPANSIONS).select("qid", F.md5("content").alias("digest"))


QUERIES = {
    "p1_safe_text": safe_text,
    "p2_build_content": build_content,
    "p2_build_content_text_tags": build_content_text_tags,
    "p3_clean_text": clean_text,
    "p3_clean_text_pages": clean_text_runs,
    "p4_add_content": add_content,
    "p5_truncate_text": truncate_text,
    "p6_tech_tokens": _token_digest("tech"),
    "p7_simple_tokens": _token_digest("simple"),
    "p8_word_tokens": _token_digest("word"),
    "p9_word_ngrams": ngrams,
    "p10_word_count": word_count,
    "p11_null_to_empty": null_to_empty,
    "p12_default_category": default_category,
    "p13_id_text": id_text,
    "p14_model_label": model_label,
    "p15_json_id_list": json_ids,
    "p16_rounded_metrics": rounded_metrics,
    "p17_category_expansion": expand,
}


def _clean(x: str) -> str:
    spaced = f"regexp_replace(lower({x}), '{sp.SPACES}+', ' ', 'g')"
    return sp.strip(f"regexp_replace({spaced}, '([!?.]){{2,}}', '\\1', 'g')")


_DIRTY = "' ' || chr(160) || url || chr(65533) || html || chr(9) || chr(10)"
_GRAMS = f"""SELECT doc_id, CAST(count(*) AS INTEGER) AS n, md5(string_agg(term, '|' ORDER BY kind, p)) AS digest FROM g GROUP BY doc_id"""

ORACLE = {
    "p1_safe_text": f"SELECT page_id, sha256({sp.safe(_DIRTY)}) AS safe, sha256({sp.strip(_DIRTY)}) AS safe_old FROM pages",
    "p2_build_content": sp.with_(sp.DOCS) + "SELECT doc_id, CAST(length(content) AS INTEGER) AS n, md5(content) AS digest FROM docs",
    "p2_build_content_text_tags": sp.with_(sp.RAW) + f"""SELECT doc_id, md5(concat_ws(' ',
  CASE WHEN lang <> 'en' AND title <> body THEN nullif({sp.safe('title')}, '') END,
  nullif({sp.safe('body')}, ''), nullif({sp.safe('lang')}, ''))) AS digest FROM d0""",
    "p3_clean_text": f"SELECT doc_id, md5({_clean('text')}) AS digest FROM documents",
    "p3_clean_text_pages": f"SELECT page_id, md5({_clean('html')}) AS digest FROM pages",
    "p4_add_content": sp.with_(sp.DOCS) + f"SELECT doc_id, md5({_clean('content')}) AS digest, CAST(2 AS INTEGER) AS n_tags FROM docs",
    "p5_truncate_text": "SELECT doc_id, md5(substr(text, 1, 512)) AS digest FROM documents",
    "p6_tech_tokens": f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {sp.tech('text')} AS t FROM documents)""",
    "p7_simple_tokens": """WITH w AS (SELECT doc_id, ws, CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END AS ws1
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS ws FROM documents)),
u AS (SELECT doc_id, unnest(ws1) AS t, generate_subscripts(ws1, 1) AS p FROM w),
k AS (SELECT doc_id, p, CASE WHEN regexp_full_match(t, '[a-z0-9]+') THEN t END AS t FROM u)
SELECT doc_id, CAST(count(t) AS INTEGER) AS n, md5(coalesce(string_agg(t, ' ' ORDER BY p), '')) AS digest FROM k GROUP BY doc_id""",
    "p8_word_tokens": f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {sp.word('text')} AS t FROM documents)""",
    "p9_word_ngrams": f"""WITH w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
  FROM (SELECT doc_id, {sp.word('text')} AS ws FROM documents)),
g AS (SELECT doc_id, 0 AS kind, p, w AS term FROM w UNION ALL
  SELECT doc_id, 1, p, term FROM (SELECT doc_id, p, w || ' ' || lead(w) OVER (PARTITION BY doc_id ORDER BY p) AS term FROM w) WHERE term IS NOT NULL)
SELECT d.doc_id, CAST(count(term) AS INTEGER) AS n, md5(coalesce(string_agg(term, '|' ORDER BY kind, p), '')) AS digest
FROM documents d LEFT JOIN g USING (doc_id) GROUP BY d.doc_id""",
    "p10_word_count": f"SELECT doc_id, CAST({sp.word_count('text')} AS INTEGER) AS n FROM documents",
    "p11_null_to_empty": "SELECT doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality_text FROM documents LEFT JOIN labels USING (doc_id)",
    "p12_default_category": """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'unknown' WHEN toxic = 1 THEN 'toxic' ELSE 'fine' END AS category
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "p13_id_text": "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn FROM conversations",
    "p14_model_label": """SELECT doc_id, CASE lang WHEN 'en' THEN 'embeddings:' || source WHEN 'de' THEN 'bm25:' || source ELSE 'tfidf' END AS model_label
FROM documents""",
    "p15_json_id_list": """SELECT conv_id, '["' || string_agg(t, '","' ORDER BY t) || '"]' AS encoded, CAST(count(*) AS INTEGER) AS n, max(t) AS last
FROM (SELECT conv_id, lpad(CAST(turn AS VARCHAR), 5, '0') AS t FROM conversations) GROUP BY conv_id""",
    "p16_rounded_metrics": sp.with_(sp.DOCS, sp.BENCH, sp.BENCH_QRELS, sp.bm25("r", "bq", "20"))
    + sp.metrics("r", "bqr", "bq", (5, 20)).replace(", 6)", ", 4)"),
    "p17_category_expansion": sp.with_(sp.RAW, sp.TITLES)
    + "SELECT qid, md5(content || ' ' || CASE category "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGE_EXPANSIONS.items())
    + " ELSE category END) AS digest FROM tq",
}
