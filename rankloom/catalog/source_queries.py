"""Readers and writers: the driver tables are written in each format and read back."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.functions.text import with_content
from rankloom.operators.fusion import fuse_named, stack_runs
from rankloom.operators.lexical import bm25_search, fit_lexical
from rankloom.operators.metrics import evaluate
from rankloom.operators.sampling import head
from rankloom.operators.submission import make_submission
from rankloom.session import scratch_path
from rankloom.sources import corpus, sinks, vector_store


def _json_records(df, id_col):
    """Records as JSON texts: tags alternate between a list and a bare string."""
    mixed = F.when(F.col("category") == "en", F.to_json("tags")).otherwise(F.concat(F.lit('"'), F.col("category"), F.lit('"')))
    record = F.struct(F.col(id_col).cast("string").alias("id"), "title", "text", F.parse_json(mixed).alias("tags"), "category")
    return df.select(F.to_json(record).alias("value"))


def _write_corpus(spark, sf, folder):
    """The four input files as JSON lines, from whole tables."""
    docs = fx.raw_docs(spark, sf)
    _json_records(docs, "doc_id").write.text(f"{folder}/{corpus.DOCS_FILE}")
    titles = fx.title_queries(spark, sf)
    train = titles.select("qid", F.col("content").alias("title"), F.lit("").alias("text"), F.array("category").alias("tags"), "category")
    _json_records(train, "qid").write.text(f"{folder}/{corpus.TRAIN_FILE}")
    test = fx.benchmark_queries(spark, sf).select(
        "qid", F.lit(None).cast("string").alias("title"), F.col("content").alias("text"), F.lit(None).cast("array<string>").alias("tags"),
        F.lit(None).cast("string").alias("category"),
    )
    _json_records(test, "qid").write.text(f"{folder}/{corpus.TEST_FILE}")
    _judgment_texts(spark, sf).write.text(f"{folder}/{corpus.QRELS_FILE}")


def _judgment_texts(spark, sf):
    """One JSON text per title query, in rotating spellings of the same judgments."""
    pairs = fx.title_qrels(spark, sf).groupBy("qid").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
    rows = fx.title_queries(spark, sf).join(pairs, "qid")
    qid = F.col("qid").cast("string")
    as_objects = F.transform("ids", lambda i: F.struct(i.alias("doc_id")))
    as_docids = F.transform("ids", lambda i: F.struct(i.cast("string").alias("docid")))
    keyed = F.to_json(F.create_map(qid, F.struct(F.col("ids").alias("relevant_doc_ids"), F.size("ids").alias("total_relevant_docs"), "category")))
    twice = F.to_json(F.create_map(qid, F.struct(F.concat("ids", "ids").alias("relevant"), F.size("ids").alias("total_relevant_docs"), "category")))
    objects = F.to_json(F.create_map(qid, F.struct(as_objects.alias("doc_ids"), F.size("ids").alias("total_relevant_docs"), "category")))
    listed = F.to_json(F.array(F.struct(F.col("qid").alias("query_id"), F.col("ids").alias("doc_ids"), F.size("ids").alias("total_relevant_docs"), "category")))
    listed_ids = F.to_json(F.array(F.struct(qid.alias("id"), as_docids.alias("relevant"), F.size("ids").alias("total_relevant_docs"), "category")))
    form = F.pmod(F.length("content"), F.lit(5))
    return rows.select(
        F.when(form == 0, keyed).when(form == 1, twice).when(form == 2, objects).when(form == 3, listed).otherwise(listed_ids).alias("value")
    )


def json_source(spark, sf):
    folder = scratch_path(spark, "json")
    _write_corpus(spark, sf, folder)
    docs = corpus.read_records(spark, f"{folder}/{corpus.DOCS_FILE}", multi_line=False)
    return docs.select("doc_id", F.md5("text").alias("digest"), "title", F.array_join("tags", ",").alias("tags"), "category")


def json_array_source(spark, sf):
    """The array form: one JSON array per language."""
    path = scratch_path(spark, "array")
    records = fx.table(spark, sf, "benchmark").select(
        F.struct(F.col("item_id").cast("string").alias("id"), F.col("text").alias("text"), F.lit("x").alias("tags")).alias("r"),
        F.substring("text", 1, 1).alias("part"),
    )
    records.groupBy("part").agg(F.to_json(F.collect_list("r")).alias("value")).select("value").repartition(8).write.text(path)
    docs = corpus.read_records(spark, path, multi_line=False)
    return docs.select("doc_id", F.md5("text").alias("digest"), F.array_join("tags", ",").alias("tags"))


def _array_lines(batches):
    """Records as the lines of one array."""
    first = True
    for batch in batches:
        values = batch.column("value").to_pylist()
        lines = [("[" if first and not i else ",") + v for i, v in enumerate(values)]
        first = first and not values
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], ["value"])


ARRAY_BYTES = 16 << 20


def json_array_ranges(spark, sf):
    """All documents in one array per task that wrote them, read in ranges much smaller than these files."""
    path = scratch_path(spark, "ranges")
    records = _json_records(fx.raw_docs(spark, sf), "doc_id")
    size = records.agg(F.sum(F.octet_length("value")).alias("n")).first()["n"] or 0
    records.coalesce(max(2, size // ARRAY_BYTES)).mapInArrow(_array_lines, "value string").write.text(path)
    docs = corpus.read_records(spark, path, range_bytes=1 << 18)
    return docs.select("doc_id", F.md5("text").alias("digest"), "title", F.array_join("tags", ",").alias("tags"), "category")


def load_all(spark, sf):
    """Row counts and id totals of the four frames."""
    folder = scratch_path(spark, "all")
    _write_corpus(spark, sf, folder)
    docs = corpus.read_records(spark, f"{folder}/{corpus.DOCS_FILE}", "doc_id", False)
    train = corpus.read_records(spark, f"{folder}/{corpus.TRAIN_FILE}", "qid", False)
    test = corpus.read_records(spark, f"{folder}/{corpus.TEST_FILE}", "qid", False)
    judged = corpus.read_judgments(spark, f"{folder}/{corpus.QRELS_FILE}", whole_text=False)
    out = None
    for name, df, key in (("docs", docs, "doc_id"), ("train", train, "qid"), ("test", test, "qid"), ("judgments", judged, "qid")):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(key).cast("long")).alias("id_total")).select(F.lit(name).alias("name"), "n", "id_total")
        out = row if out is None else out.unionByName(row)
    return out


def judgments(spark, sf):
    return corpus.judgment_pairs(corpus.parse_judgments(_judgment_texts(spark, sf)))


def judgment_entries(spark, sf):
    """Entries per query after flattening, null dropping and deduplication."""
    parsed = corpus.parse_judgments(_judgment_texts(spark, sf))
    pairs = corpus.judgment_pairs(parsed).groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    return parsed.select("qid", F.col("total_relevant_docs").alias("stated")).join(pairs, "qid", "left")


def judgment_categories(spark, sf):
    return corpus.judgment_categories(corpus.parse_judgments(_judgment_texts(spark, sf)))


def search_inputs(spark, sf):
    """Prepared tables win over raw files; both give the same content."""
    raw, ready = scratch_path(spark, "raw"), scratch_path(spark, "ready")
    _write_corpus(spark, sf, raw)
    rebuilt, queries = corpus.read_search_inputs(spark, raw, ready, clean=True, multi_line=False)
    sinks.write_prepared(rebuilt, queries, queries, ready)
    docs, _ = corpus.read_search_inputs(spark, raw, ready, clean=True, multi_line=False)
    return docs.select("doc_id", F.md5("content").alias("digest"))


def prepared_sink(spark, sf):
    path = scratch_path(spark, "prepared")
    docs, q = fx.docs(spark, sf), fx.benchmark_queries(spark, sf)
    sinks.write_prepared(docs, q, q, path)
    return spark.read.parquet(f"{path}/docs").select("doc_id", F.md5("content").alias("digest"))


def embedding_misses(spark, sf):
    """The store already knows the labelled documents; the others must be encoded."""
    tag = vector_store.encoder_tag(dim=64, model="hash")
    docs = fx.docs(spark, sf).select("doc_id", "content")
    known = docs.join(fx.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    store = vector_store.with_key(known, tag)
    return vector_store.missing_rows(vector_store.with_key(docs, tag), store).select("doc_id", "key")


def embedding_store(spark, sf):
    """Two rounds against one store: labelled documents first, then all."""
    path = scratch_path(spark, "vectors")
    docs = fx.docs(spark, sf).select("doc_id", "content")
    labelled = docs.join(fx.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    vector_store.update_store(spark, labelled, path)
    found = vector_store.update_store(spark, docs, path)
    entries = found.select("doc_id", F.posexplode("embedding").alias("i", "v"))
    return entries.groupBy("doc_id").agg(F.round(F.sum(F.col("v") * (F.col("i") + 1)), 6).alias("checksum"), F.count(F.lit(1)).alias("dim"))


def _lists(spark, sf, k=20):
    q = fx.benchmark_queries(spark, sf)
    return bm25_search(fit_lexical(fx.docs(spark, sf)), q, k), q


def submission_sink(spark, sf):
    run, q = _lists(spark, sf)
    path = scratch_path(spark, "submission")
    sinks.write_submission(make_submission(run, q, 20), path, 20, "?")
    return sinks.read_submission(spark, path)


def table_csv(spark, sf):
    run, q = _lists(spark, sf)
    path = scratch_path(spark, "table")
    table = evaluate(run, fx.benchmark_qrels(spark, sf), q, [1, 5, 10, 20])
    sinks.write_table_csv(table, path)
    return sinks.read_table_csv(spark, path, table.schema).orderBy("k")


def method_export(spark, sf):
    run, q = _lists(spark, sf)
    okapi = bm25_search(fit_lexical(fx.docs(spark, sf)), q, 20, "okapi")
    both = fuse_named(stack_runs({"plus": run, "okapi": okapi}), ["plus", "okapi"], {"plus": 1.0, "okapi": 1.0}, 20)
    out = None
    for label, r in (("bm25:plus", run), ("bm25:okapi", okapi), ("fused", both)):
        part = make_submission(r, q, 20).withColumn("model_label", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return sinks.export_by_label(out, scratch_path(spark, "export")).drop("path")


def run_metadata(spark, sf):
    run, q = _lists(spark, sf)
    table = evaluate(run, fx.benchmark_qrels(spark, sf), q, [20]).first().asDict()
    path = scratch_path(spark, "runs")
    sinks.append_run_metadata(spark, path, {"top_k": 20}, table, "none", datetime(2024, 5, 6, 7, 8, 9))
    rows = spark.read.schema("run string, config string, metrics string, submission_path string").json(path)
    metrics = F.from_json("metrics", "k int, precision double, recall double, mrr double")
    return rows.select("run", "config", metrics.alias("m"), "submission_path").select("run", "config", "m.*", "submission_path")


QUERIES = {
    "s1_json_source": json_source,
    "s1_json_array_source": json_array_source,
    "s1_json_array_ranges": json_array_ranges,
    "s2_load_all": load_all,
    "s3_judgments": judgments,
    "s4_judgment_entries": judgment_entries,
    "s5_judgment_categories": judgment_categories,
    "s6_search_inputs": search_inputs,
    "s7_prepared_sink": prepared_sink,
    "s8_embedding_misses": embedding_misses,
    "s8_embedding_store": embedding_store,
    "s9_submission_sink": submission_sink,
    "s10_table_csv": table_csv,
    "s11_method_export": method_export,
    "s12_run_metadata": run_metadata,
}

_CLEAN = lambda x: sp.strip(
    f"regexp_replace(regexp_replace(lower({x}), '{sp.SPACES}+', ' ', 'g'), '([!?.]){{2,}}', '\\1', 'g')"
)
_JSON_TAGS = "CASE WHEN lang = 'en' THEN lang || ',' || source ELSE lang END"
_RUN20 = sp.with_(sp.DOCS, sp.BENCH, sp.BENCH_QRELS, sp.bm25("r", "bq", "20"))

ORACLE = {
    "s1_json_source": sp.with_(sp.RAW) + f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(body) AS digest, title, {_JSON_TAGS} AS tags, lang AS category FROM d0""",
    "s1_json_array_source": "SELECT CAST(item_id AS VARCHAR) AS doc_id, md5(text) AS digest, 'x' AS tags FROM benchmark",
    "s2_load_all": sp.with_(sp.RAW, sp.TITLES) + """SELECT 'docs' AS name, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS id_total FROM documents
UNION ALL SELECT 'train', count(*), CAST(sum(qid) AS BIGINT) FROM tq
UNION ALL SELECT 'test', count(*), CAST(sum(item_id) AS BIGINT) FROM benchmark
UNION ALL SELECT 'judgments', count(*), CAST(sum(qid) AS BIGINT) FROM tq""",
    "s3_judgments": sp.with_(sp.RAW, sp.TITLES, sp.TITLE_QRELS) + "SELECT CAST(qid AS VARCHAR) AS qid, CAST(doc_id AS VARCHAR) AS doc_id FROM tqr",
    "s4_judgment_entries": sp.with_(sp.RAW, sp.TITLES, sp.TITLE_QRELS)
    + "SELECT CAST(qid AS VARCHAR) AS qid, CAST(count(*) AS INTEGER) AS stated, count(*) AS n FROM tqr GROUP BY qid",
    "s5_judgment_categories": sp.with_(sp.RAW, sp.TITLES) + "SELECT CAST(qid AS VARCHAR) AS qid, category FROM tq",
    "s7_prepared_sink": sp.with_(sp.DOCS) + "SELECT doc_id, md5(content) AS digest FROM docs",
    "s8_embedding_misses": sp.with_(sp.DOCS)
    + "SELECT doc_id, sha256('dim=64|model=hash:' || content) AS key FROM docs WHERE content NOT IN (SELECT content FROM docs JOIN labels USING (doc_id))",
    "s8_embedding_store": sp.with_(sp.DOCS, sp.hashed("h", "docs", "doc_id"))
    + "SELECT doc_id, round(coalesce(sum(v * (i + 1)), 0), 6) AS checksum, CAST(64 AS BIGINT) AS dim FROM docs LEFT JOIN h USING (doc_id) GROUP BY doc_id",
    "s9_submission_sink": _RUN20
    + """SELECT CAST(qid AS VARCHAR) AS query_id, '["' || string_agg(CAST(doc_id AS VARCHAR), '","' ORDER BY rank) || '"]' AS relevant_doc_ids, '?' AS category FROM r GROUP BY qid""",
    "s10_table_csv": _RUN20 + sp.metrics("r", "bqr", "bq", (1, 5, 10, 20)),
    "s12_run_metadata": _RUN20
    + f"""SELECT '20240506_070809' AS run, '{{"top_k": 20}}' AS config, m.*, 'none' AS submission_path FROM ({sp.metrics("r", "bqr", "bq", (20,))}) m""",
    "s11_method_export": "SELECT unnest(['bm25:plus', 'bm25:okapi', 'fused']) AS model_label, count(*) AS n_rows, CAST(20 AS INTEGER) AS top_k FROM benchmark",
}
ORACLE["s1_json_array_ranges"] = ORACLE["s1_json_source"]
_S6 = f"""concat_ws(' ', nullif({sp.safe('title')}, ''), nullif({sp.safe('body')}, ''),
  CASE WHEN lang = 'en' THEN lang || ' ' || source ELSE lang END)"""
ORACLE["s6_search_inputs"] = sp.with_(sp.RAW) + f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5({_CLEAN(_S6)}) AS digest FROM d0"
