"""Filters, subsets, samples."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.operators import sampling as sa
from rankloom.operators.lexical import bm25_search, fit_lexical
from rankloom.operators.metrics import check_judged

# The subset size is the argument of these operators.
SUBSET = 150


def head(spark, sf):
    return sa.head(fx.table(spark, sf, "documents").select("doc_id", "lang"), SUBSET)


def relevant_subset(spark, sf):
    docs = fx.raw_docs(spark, sf).select("doc_id", "category")
    return sa.relevant_first_subset(docs, fx.benchmark_qrels(spark, sf), SUBSET)[0]


def relevant_subset_judgments(spark, sf):
    docs = fx.raw_docs(spark, sf).select("doc_id", "category")
    return sa.relevant_first_subset(docs, fx.title_qrels(spark, sf), SUBSET)[1]


def balanced(spark, sf):
    return sa.balanced_subset(fx.raw_docs(spark, sf).select("doc_id", "category"), SUBSET)


def sample(spark, sf):
    """A seeded sample of pages; the size is the feature."""
    return sa.seeded_sample(fx.table(spark, sf, "pages").select(F.col("page_id").alias("qid"), "url"), 40, 42)


def evaluable(spark, sf):
    q = fx.benchmark_queries(spark, sf)
    return sa.evaluable_queries(q, fx.benchmark_qrels(spark, sf), fx.raw_docs(spark, sf)).select("qid")


def quality(spark, sf):
    docs = fx.docs(spark, sf).select("content")
    pages = fx.table(spark, sf, "pages").select(F.concat("html", F.lit("�")).alias("content"))
    turns = fx.table(spark, sf, "conversations").select(F.nullif("text", "role").alias("content"))
    return sa.content_quality({"documents": docs, "pages": pages, "turns": turns})


def bad_characters(spark, sf):
    """The marker is a letter here, because the tables hold no broken characters."""
    return sa.locate_bad_characters(fx.raw_docs(spark, sf), "ß")


def cutoffs(spark, sf):
    return sa.valid_cutoffs([10, 100, 1000, 10000, 100000], fx.table(spark, sf, "pages").select("page_id"))


def argument_checks(spark, sf):
    """Calls on the real tables and whether they are refused, each with the error that says why."""
    docs, q = fx.docs(spark, sf), fx.benchmark_queries(spark, sf)
    index = fit_lexical(docs)
    calls = {
        "no rows": (lambda: bm25_search(index, q, 0), "can't be made"),
        "unknown form": (lambda: bm25_search(index, q, 10, "other"), "is none of"),
        "more rows than documents": (lambda: bm25_search(index, q, docs.count() + 1).count(), "can't fill a ranking"),
        "unjudged queries": (lambda: check_judged(q, fx.benchmark_qrels(spark, sf)), "not judged"),
        "a proper call": (lambda: bm25_search(index, q, 1).count(), ""),
    }
    rows = []
    for name, (call, reason) in calls.items():
        refused = False
        try:
            call()
        except (ValueError, PySparkException) as fault:  # data-dependent checks run inside Spark
            if not reason or reason not in str(fault):
                raise
            refused = True
        rows.append((name, refused))
    return spark.createDataFrame(rows, "call string, refused boolean")


QUERIES = {
    "f1_head_limit": head,
    "f2_relevant_subset": relevant_subset,
    "f2_relevant_subset_judgments": relevant_subset_judgments,
    "f3_balanced_subset": balanced,
    "f4_seeded_sample": sample,
    "f5_evaluable_queries": evaluable,
    "f6_content_quality": quality,
    "f7_bad_characters": bad_characters,
    "f8_valid_cutoffs": cutoffs,
    "f9_argument_checks": argument_checks,
}

_SUB = """sub AS (SELECT doc_id, category FROM (
  SELECT doc_id, category, row_number() OVER (ORDER BY rel DESC, doc_id) AS r, sum(rel) OVER () AS n_rel
  FROM (SELECT doc_id, lang AS category, CASE WHEN doc_id IN (SELECT doc_id FROM {qr}) THEN 1 ELSE 0 END AS rel FROM documents))
  WHERE r <= greatest({n}, n_rel))"""


def _quality(name: str, table: str, content: str) -> str:
    wc = sp.word_count(content)
    return f"""SELECT '{name}' AS collection, count(*) AS n, count(*) FILTER ({content} IS NULL) AS is_null,
  count(*) FILTER ({content} IS NOT NULL AND {wc} = 0) AS is_empty, count(*) FILTER ({wc} > 0 AND {wc} < 3) AS too_short,
  count(*) FILTER (contains({content}, chr(65533))) AS bad_encoding, count(*) - count(DISTINCT {content}) AS duplicates FROM {table}"""


ORACLE = {
    "f1_head_limit": f"SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT {SUBSET}",
    "f2_relevant_subset": sp.with_(sp.BENCH_QRELS, _SUB.format(qr="bqr", n=SUBSET)) + "SELECT doc_id, category FROM sub",
    "f2_relevant_subset_judgments": sp.with_(sp.RAW, sp.TITLES, sp.TITLE_QRELS, _SUB.format(qr="tqr", n=SUBSET))
    + "SELECT qid, doc_id FROM tqr WHERE doc_id IN (SELECT doc_id FROM sub)",
    "f3_balanced_subset": f"""WITH c AS (
  SELECT doc_id, lang AS category, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r,
         greatest(1, {SUBSET} // (SELECT count(DISTINCT lang) FROM documents)) AS per FROM documents),
a AS (SELECT doc_id, category FROM c WHERE r <= per),
b AS (SELECT doc_id, category FROM c WHERE r > per ORDER BY doc_id LIMIT greatest(0, {SUBSET} - (SELECT count(*) FROM a)))
SELECT * FROM a UNION ALL SELECT * FROM b""",
    "f4_seeded_sample": "SELECT page_id AS qid, url FROM pages ORDER BY md5('42:' || page_id), page_id LIMIT 40",
    "f5_evaluable_queries": sp.with_(sp.BENCH_QRELS) + "SELECT DISTINCT qid FROM bqr",
    "f6_content_quality": sp.with_(
        sp.DOCS,
        "pg AS (SELECT html || chr(65533) AS content FROM pages)",
        "cv AS (SELECT nullif(text, role) AS content FROM conversations)",
        "u AS (" + " UNION ALL ".join(_quality(n, t, "content") for n, t in (("documents", "docs"), ("pages", "pg"), ("turns", "cv"))) + ")",
    ) + "SELECT *, is_null + is_empty + too_short + bad_encoding AS critical FROM u",
    "f7_bad_characters": sp.with_(sp.RAW) + """SELECT doc_id, contains(title, 'ß') AS in_title, contains(body, 'ß') AS in_text,
  contains(lang, 'ß') OR contains(source, 'ß') AS in_tags FROM d0 WHERE contains(title, 'ß') OR contains(body, 'ß') OR contains(lang || source, 'ß')""",
    "f8_valid_cutoffs": "SELECT CAST(k AS INTEGER) AS k FROM (SELECT unnest([10, 100, 1000, 10000, 100000]) AS k) WHERE k <= (SELECT count(*) FROM pages)",
    "f9_argument_checks": sp.with_(sp.BENCH_QRELS)
    + """SELECT 'no rows' AS call, true AS refused UNION ALL SELECT 'unknown form', true UNION ALL SELECT 'more rows than documents', true
UNION ALL SELECT 'unjudged queries', count(*) > 0 FROM benchmark WHERE item_id NOT IN (SELECT qid FROM bqr)
UNION ALL SELECT 'a proper call', count(*) = 0 FROM documents""",
}
