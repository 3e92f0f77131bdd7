"""The pipeline on sf0.001: each stage's decision holds for what it kept."""

import corpus_pipeline
from rankloom.llm import byte_bpe, decontaminate, pii


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and left
        ids = left
    assert not decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").count()
    assert all(not pii.base_spans(r.text) for r in docs.collect())
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    enc = byte_bpe.encoding(corpus_pipeline.RANKS, corpus_pipeline.public_tokenizers.PATTERN)
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(enc.encode_ordinary(t or "")) for i, t in texts.items()}


def awkward(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    words = [a + b + c for a in "bdfgklmn" for b in ("ara", "eno", "ilo", "otu") for c in "bdfgklmn"]
    long = " ".join(words[(i * 7919 + i // 256 * 31) % 256] + str(i % 97) for i in range(30_000))
    texts = [(1, None), (2, ""), (None, None), (None, "one text without an id"), (None, "another text without an id"), (5, "short"), (5, "short"), (6, long), (6, long), (7, " \n\t")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, key string, size string, `component_id` string, `class` string"
    rows = [(i, t, None if n % 2 else "en", None, None if t is None else len(t), n, "k", "s", "c", "x") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, schema), texts


def test_awkward_rows_pass_every_stage(spark, sf_dir):
    docs, texts = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), docs.schema)
        empty = stage(spark, docs.where("false"), sf_dir)
        assert empty.columns == docs.columns and empty.count() == 0, name
    left = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    assert left == sorted((i or 0, t or "") for i, t in texts)  # rows that repeat an id share its decision
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    enc = byte_bpe.encoding(corpus_pipeline.RANKS, corpus_pipeline.public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == sorted((i or 0, len(enc.encode_ordinary(t or ""))) for i, t in texts)
