"""N-grams counted and weighed in blocks, against the same by hand."""

import math
import os
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankloom.operators import classify, gram_blocks
from rankloom.session import shared_dir

ROWS = [
    ("a", "red fish blue fish red fish", "x"), ("a", "red bird", "x"), ("b", "blue bird sings", "y"), ("c", None, "y"),
    ("d", "", "x"), (None, "red red", "y"), (None, "fish bird", None), ("e", "fish", "y"), ("b", "blue bird sings", "y"),
]


def grams(text):
    words = [w for w in (text or "").split() if len(w) > 1]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def by_hand(rows):
    df = Counter(t for _, text, _ in rows for t in grams(text))
    idf = {t: math.log((1 + len(rows)) / (1 + n)) + 1 for t, n in df.items()}
    found = defaultdict(list)
    for key, text, _ in rows:
        found[key] += [(t, (1 + math.log(n)) * idf[t]) for t, n in grams(text).items()]
    length = {k: math.sqrt(sum(w * w for _, w in v)) for k, v in found.items()}
    return df, {k: sorted((t, round(w / length[k], 9)) for t, w in v) for k, v in found.items() if v}


@pytest.mark.parametrize("batch", [3, 10_000])
def test_blocks_weigh_as_whole_table(spark, monkeypatch, batch):
    """Repeated and null ids, empty texts, several blocks, terms that cross the batches of a range."""
    monkeypatch.setattr(gram_blocks, "MIN_BLOCK_BYTES", 16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(ROWS, "row_id string, text string, label string")
        model = classify.fit_features(df)
        terms = {r.idx: r for r in model.vocabulary.collect()}
        stats, want = by_hand(ROWS)
        assert [terms[i].term for i in range(len(stats))] == sorted(stats) and model.width == len(stats)
        assert {r.term: r.df for r in terms.values()} == stats
        got = defaultdict(list)
        for r in model.transform(df).collect():
            got[r.row_id].append((terms[r.idx].term, round(r.weight, 9)))
        assert {k: sorted(v) for k, v in got.items()} == want
        sums = {(r.label, r.idx): r.w for r in model.class_sums().groupBy("label", "idx").agg(F.round(F.sum("weight"), 9).alias("w")).collect()}
        long = model.transform(df, keep=["label"]).groupBy("label", "idx").agg(F.round(F.sum("weight"), 9).alias("w")).collect()
        assert sums == {(r.label, r.idx): r.w for r in long}
        nb = classify.fit_naive_bayes(model.class_sums(), df.select("row_id", "label"), model.vocabulary)
        ranked = lambda features: sorted((str(r.row_id), str(r.category), round(r.jll, 8)) for r in nb.scores(features, df).collect())
        assert ranked(nb.votes(model, df)) == ranked(model.transform(df))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_what_is_stored_stays_near_the_text(spark, monkeypatch):
    """A vocabulary too large to broadcast; the rows of all n-grams were stored several times before."""
    from rankloom.catalog import classify_queries as cq

    monkeypatch.setattr(classify, "fits_broadcast", lambda table: False)
    texts = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "en").otherwise("de").alias("category"),
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(120)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64(F.col("id"), i), F.lit(3000)))), " ").alias("text"),
    )
    monkeypatch.setattr(cq.fx, "raw_docs", lambda *_: texts)
    folder = shared_dir(spark).removeprefix("file:")
    before = folder_bytes(folder)
    cq.QUERIES["c5_naive_bayes"](spark, "").write.format("noop").mode("overwrite").save()
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"]
    assert folder_bytes(folder) - before < 8 * size


@pytest.mark.parametrize("batch", [2, 10_000])
def test_terms_are_counted_by_batches(spark, batch):
    """Rows of repeated and null ids count by themselves; the work was an interpreted expression per token before."""
    from rankloom.functions.text import tech_tokens
    from rankloom.operators.lexical import count_terms

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = [(1, "x", "Red red c++"), (1, "x", "red"), (None, None, "Fish"), (2, "y", None), (3, "y", "")]
        counted = count_terms(spark.createDataFrame(rows, "id long, k string, text string"), ["id", "k"], tech_tokens("text"))
        assert counted.dtypes == [("id", "bigint"), ("k", "string"), ("dl", "int"), ("term", "string"), ("tf", "int")]
        assert Counter(map(tuple, counted.collect())) == Counter([
            (1, "x", 3, "", 1), (1, "x", 3, "red", 2), (1, "x", 3, "c++", 1), (1, "x", 1, "", 1), (1, "x", 1, "red", 1),
            (None, None, 1, "", 1), (None, None, 1, "fish", 1), (2, "y", 0, "", 1), (3, "y", 0, "", 1),
        ])
        assert "MapInArrow" in counted._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_packed_numbers_come_back():
    rows = [[], [0], [3, 4, 200, 70_000, 2**31 - 2], [], [127, 128, 16_383, 16_384], []]
    ends = np.append(0, np.cumsum([len(r) for r in rows]))
    code = np.array([x for r in rows for x in r], np.int64)
    numbers, n = gram_blocks._flat(pa.chunked_array([gram_blocks._packed(code, ends)]))
    assert numbers.tolist() == code.tolist() and n.tolist() == [len(r) for r in rows]
    step = np.array([x - (r[i - 1] if i else 0) for r in rows for i, x in enumerate(r)], np.int64)
    packed = gram_blocks._packed(step, ends)
    numbers, n = gram_blocks._flat(pa.chunked_array([packed]))
    assert gram_blocks._risen(numbers, n).tolist() == code.tolist()
    assert sum(len(x.as_py()) for x in packed) < 4 * len(code)
    none = pa.chunked_array([gram_blocks._packed(np.zeros(0, np.int64), np.zeros(3, np.int64))])
    assert [x.tolist() for x in gram_blocks._flat(none)] == [[], [0, 0]]


def test_words_are_stored_once_and_not_with_the_sums_of_classes(spark):
    df = spark.createDataFrame([(f"r{i}", f"red fish w{i}", "xy"[i % 2]) for i in range(40)], "row_id string, text string, label string")
    model = classify.fit_features(df)
    named = model.numbered.where("term is not null")
    assert named.count() == named.select("term").distinct().count() == model.width
    nb = classify.fit_naive_bayes(model.class_sums(), df.select("row_id", "label"), model.vocabulary)
    assert nb.mass.columns == ["idx", "mass"] and nb.mass.count() == model.width
    # what is stored is compressed for space
    assert any(name.endswith(".zstd.parquet") for name in os.listdir(model.training.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]))
