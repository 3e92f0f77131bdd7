"""Sparse, dense and fused rankings against brute force in Python."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import common, dense, fusion, lexical, rerank
from rankloom.functions.text import TECH_TOKEN_PATTERN
from rankloom.sources import vector_store

TEXTS = ["the cat sat", "the dog sat sat", "c++ code and the cat", "nothing here", "dog dog dog"]
QUERIES = ["cat cat sat zebra", "dog", "unknown words only"]


def frames(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, content string")
    queries = spark.createDataFrame([(i, t) for i, t in enumerate(QUERIES)], "qid long, content string")
    return docs, queries


def brute_bm25(method):
    toks = [re.findall(TECH_TOKEN_PATTERN, t.lower()) for t in TEXTS]
    n, avg = len(toks), sum(map(len, toks)) / len(toks)
    df = {w: sum(w in t for t in toks) for t in toks for w in t}
    if method == "plus":
        idf = {w: math.log((n + 1) / d) for w, d in df.items()}
    else:
        raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
        mean = sum(raw.values()) / len(raw)
        idf = {w: (v if v >= 0 else 0.25 * mean) for w, v in raw.items()}
    out = []
    for q in QUERIES:
        row = []
        for t in toks:
            s = 0.0
            for w in re.findall(TECH_TOKEN_PATTERN, q.lower()):
                tf = t.count(w)
                part = tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(t) / avg))
                s += idf.get(w, 0.0) * (part + (1.0 if method == "plus" else 0.0))
            row.append(s)
        out.append(row)
    return out


@pytest.mark.parametrize("method", ["plus", "okapi"])
def test_bm25_matches_brute_force(spark, method):
    docs, queries = frames(spark)
    got = lexical.bm25_search(lexical.fit_lexical(docs), queries, 5, method).collect()
    want = brute_bm25(method)
    assert len(got) == 15
    for row in got:
        assert row["score"] == pytest.approx(want[row["qid"]][row["doc_id"]], abs=1e-9)
    for q in range(3):
        ranked = [r["doc_id"] for r in sorted((r for r in got if r["qid"] == q), key=lambda r: r["rank"])]
        assert ranked == sorted(range(5), key=lambda d: (-round(want[q][d], 9), d))


def test_okapi_with_negative_mean_idf(spark):
    """Every term in most documents: matches score below zero and rank behind the others."""
    docs = spark.createDataFrame([(0, "a b"), (1, "a b"), (2, "a b"), (3, "x")], "doc_id long, content string")
    queries = spark.createDataFrame([(1, "a"), (2, "b x")], "qid long, content string")
    toks = [["a", "b"]] * 3 + [["x"]]
    raw = {w: math.log(4 - d + 0.5) - math.log(d + 0.5) for w, d in {"a": 3, "b": 3, "x": 1}.items()}
    floor = 0.25 * sum(raw.values()) / 3
    assert floor < 0
    for k in (1, 2, 4):
        got = lexical.bm25_search(lexical.fit_lexical(docs), queries, k, "okapi").where("qid = 1").orderBy("rank").collect()
        assert [r["doc_id"] for r in got] == [3, 0, 1, 2][:k]


def test_bm25_arguments(spark):
    docs, queries = frames(spark)
    index = lexical.fit_lexical(docs)
    with pytest.raises(ValueError):
        lexical.bm25_search(index, queries, 0)
    with pytest.raises(ValueError):
        lexical.bm25_search(index, queries, 3, "bm42")
    with pytest.raises(Exception, match="can't fill a ranking"):
        lexical.bm25_search(index, queries, 6).collect()


def test_shuffled_join_gives_the_same_run(spark, monkeypatch):
    """Beyond the broadcast limit the search takes the salted join."""
    docs, queries = frames(spark)
    want = lexical.bm25_search(lexical.fit_lexical(docs), queries, 5).orderBy("qid", "rank").collect()
    monkeypatch.setattr(lexical, "fits_broadcast", lambda df: False)
    got = lexical.bm25_search(lexical.fit_lexical(docs), queries, 5).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["doc_id"]) for r in got] == [(r["qid"], r["doc_id"]) for r in want]


def test_knn_matches_numpy(spark):
    rng = np.random.default_rng(7)
    d, q = rng.normal(size=(60, 8)), rng.normal(size=(9, 8))
    dv = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(d)], "doc_id long, embedding array<double>").repartition(4)
    qv = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "qid long, embedding array<double>")
    sims = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (d / np.linalg.norm(d, axis=1, keepdims=True)).T
    for options in ({}, {"chunk_bytes": 600}, {"blocks": (2, 5)}, {"blocks": (10, 100)}):
        got = dense.knn_search(dv, qv, 7, **options).collect()
        assert len(got) == 63
        for r in got:
            assert r["score"] == pytest.approx(sims[r["qid"], r["doc_id"]])
            assert np.argsort(-sims[r["qid"]])[r["rank"] - 1] == r["doc_id"]
    with pytest.raises(ValueError):
        dense.knn_search(dv, qv, 61)


def test_one_long_vector_behind_many(spark):
    """Every row decides whether the vectors have length one."""
    rows = [(i, [math.cos(i), math.sin(i)]) for i in range(400)]
    even = spark.createDataFrame(rows, "doc_id long, embedding array<double>").coalesce(1)
    odd = spark.createDataFrame([*rows, (400, [30.0, 40.0])], "doc_id long, embedding array<double>").coalesce(1)
    assert dense.unit_norm_check(even).first()["unit_norm"] and not dense.unit_norm_check(odd).first()["unit_norm"]
    query = spark.createDataFrame([(1, [0.6, 0.8])], "qid long, embedding array<double>")
    best = dense.knn_search(odd, query, 1).first()
    assert best["doc_id"] == 400 and best["score"] == pytest.approx(1.0)


def test_ranks_beyond_a_thousand_rows(spark):
    rows = [(1, t, (t * 7) % 30) for t in range(1500)] + [(2, 0, None), (2, 1, 5), (None, 0, 1)]
    df = spark.createDataFrame(rows, "g long, t long, n long").withColumn("b", -F.col("n"))
    got = {(r.g, r.t): r["rank"] for r in common.bucket_rank(df, ["g"], "b", [F.col("t")]).collect()}
    order = sorted((r for r in rows if r[0] == 1), key=lambda r: (-r[2], r[1]))
    assert len(got) == len(rows) and all(got[1, r[1]] == i for i, r in enumerate(order, 1))
    assert got[2, 1] == 1 and got[2, 0] == 2 and got[None, 0] == 1


def test_pair_scorer_reads_whole_documents(spark):
    docs = spark.createDataFrame([(1, "x " * 600 + "needle"), (2, "x")], "doc_id long, content string")
    run = spark.createDataFrame([(1, 1, 2, 1.0), (1, 2, 1, 0.5)], "qid long, rank int, doc_id long, score double")
    queries = spark.createDataFrame([(1, "needle")], "qid long, content string")
    assert rerank.pair_rerank(run, queries, docs).where("rank = 1").first()["doc_id"] == 1


def test_store_keeps_models_apart(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, content string")
    path = str(tmp_path / "vectors")
    one = {r.doc_id: r.embedding for r in vector_store.update_store(spark, docs, path, model="one", dim=4).collect()}
    vector_store.update_store(spark, docs, path, model="two", dim=4).collect()
    assert vector_store.read_store(spark, path).select("key").distinct().count() == 4 and len(one) == 2
    with pytest.raises(ValueError):
        vector_store.update_store(spark, docs, path, make_predict_fn=lambda: None)


def test_fusion_ties_keep_dense_first(spark):
    run = lambda rows: spark.createDataFrame(rows, "qid long, rank int, doc_id long, score double")
    a = run([(1, 1, 10, 1.0), (1, 2, 11, 0.9)])
    b = run([(1, 1, 12, 1.0), (1, 2, 10, 0.9)])
    got = fusion.fuse_rankings_rrf(a, b, 3, 60, 1.0, 1.0).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [10, 12, 11]
    got = fusion.fuse_rankings_rrf(a, b.where("rank = 1"), 3, 60, 1.0, 1.0).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [10, 12, 11]
    with pytest.raises(ValueError):
        fusion.fuse_rankings_rrf(a, b, 3, 0)
    with pytest.raises(ValueError):
        fusion.resolve_weights({"a": 1.0}, {"b": 1.0})


def test_hard_filter_is_a_permutation(spark):
    run = spark.createDataFrame(
        [(1, 1, 5, 9.0, "x"), (1, 2, 6, 8.0, "y"), (1, 3, 7, 7.0, "x")], "qid long, rank int, doc_id long, score double, category string"
    )
    pred = spark.createDataFrame([(1, "y")], "qid long, prediction string")
    assert [r["doc_id"] for r in rerank.hard_filter(run, pred).orderBy("rank").collect()] == [6, 5, 7]
    assert [r["doc_id"] for r in rerank.hard_filter(run, pred, fallback=False).collect()] == [6]
    assert rerank.soft_boost(run, None) is run


def test_top_per_group_with_a_hot_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("g"), "id")
    got = common.top_per_group(rows, ["g"], [F.col("id").desc()], 4, spread_by=["id"]).where("g = 1").orderBy("rank").collect()
    assert [r["id"] for r in got] == [4998, 4995, 4992, 4989]


def test_hash_rank_is_the_global_rank(spark):
    rows = spark.range(2000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("label"))
    got = {r["row_id"]: r["rn"] for r in common.hash_rank(rows, "label", "row_id", 42).collect()}
    import hashlib

    for label in ("hot", "cold"):
        ids = [i for i in range(2000) if (i % 3 == 0) == (label == "hot")]
        ordered = sorted(ids, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
        assert all(got[i] == n for n, i in enumerate(ordered, 1))


def test_knn_plan_has_no_cross_join(spark):
    docs, queries = frames(spark)
    run = lexical.bm25_search(lexical.fit_lexical(docs), queries, 3)
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_long_rankings_are_cut_before_they_move(spark):
    """Beyond the length Spark cuts by itself, the k-th score's level does it."""
    rng = np.random.default_rng(3)
    scores = np.concatenate([rng.normal(size=20_000) * 10.0 ** rng.integers(-300, 300, 20_000), [0.0, -0.0, np.inf, -np.inf]])
    rows = [(i % 2 or None, i, float(s)) for i, s in enumerate(scores)] + [(1, -1, None)]
    df = common.materialise(spark.createDataFrame(rows, "qid long, doc_id long, score double").repartition(5))
    kept = common.above_kth(df, ["qid"], "score", 3000).groupBy("qid").count().collect()
    assert len(kept) == 2 and all(3000 <= r["count"] < 3400 for r in kept)
    got = common.top_k(df, 3000, digits=300).collect()
    assert len(got) == 6000
    for q in (1, None):
        mine = sorted((r for r in rows if r[0] == q and r[2] is not None), key=lambda r: (-r[2], r[1]))[:3000]
        assert [r.doc_id for r in sorted((r for r in got if r.qid == q), key=lambda r: r["rank"])] == [r[1] for r in mine]


@pytest.mark.parametrize("bucket, step", [(1 << 16, 4096), (4, 2), (1, 1)])
def test_free_ids(spark, monkeypatch, bucket, step):
    monkeypatch.setattr(common, "FREE_BUCKET", bucket)
    monkeypatch.setattr(common, "FREE_STEP", step)
    ids = [10 * i for i in range(30)]
    taken = {1: ids[:5] + ids[7:9], 2: [], 3: ids, 4: ids[28:], 5: ids[::2]}
    need = {1: 4, 2: 30, 3: 0, 4: 28, 5: 15}
    places = common.global_position(spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(4), "doc_id", "pos", 7)
    assert [r.pos for r in places.orderBy("doc_id").collect()] == list(range(30))
    pairs = spark.createDataFrame([(q, d) for q, t in taken.items() for d in t], "qid long, doc_id long")
    got = common.free_ids(places, 30, pairs, spark.createDataFrame(list(need.items()), "qid long, need long")).collect()
    for q in taken:
        free = [d for d in ids if d not in taken[q]][: need[q]]
        assert [r.doc_id for r in sorted((r for r in got if r.qid == q), key=lambda r: r.free)] == free
        assert sorted(r.free for r in got if r.qid == q) == list(range(need[q]))


@pytest.mark.parametrize("method", ["plus", "okapi"])
def test_filling_by_position_gives_the_same_run(spark, monkeypatch, method):
    docs, queries = frames(spark)
    rows = lambda: sorted((r.qid, r["rank"], r.doc_id, round(r.score, 9)) for r in lexical.bm25_search(lexical.fit_lexical(docs), queries, 5, method).collect())
    want = rows()
    monkeypatch.setattr(lexical, "LISTED_FILL", 0)
    assert rows() == want and len(want) == 15
    with pytest.raises(ValueError, match="can't fill a ranking"):
        lexical.bm25_search(lexical.fit_lexical(docs), queries, 6)


def test_blocks_of_any_size_give_the_same_ranking(spark, monkeypatch):
    """Pairs of query and document are summed block by block; ids that repeat count as one document."""
    from rankloom.operators import lexical

    rows = [(i % 50, " ".join(f"w{(i * j) % 17}" for j in range(1, 2 + i % 9))) for i in range(60)] + [(None, "w1 w2 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    queries = spark.createDataFrame([(i, f"w{i} w{i + 3} w{i} none") for i in range(12)] + [(3, "w5 w1")], "qid long, content string")
    index = lexical.fit_lexical(docs)
    ranked = lambda run: sorted((r.qid, r.rank, r.doc_id or -1, round(r.score, 9)) for r in run.collect())
    whole = {m: ranked(lexical.bm25_search(index, queries, 5, m)) for m in lexical.BM25_METHODS}
    cosine = ranked(lexical.tfidf_search(lexical.fit_tfidf(docs.where("doc_id is not null")), queries, 5))
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", 40)
    monkeypatch.setattr(lexical, "BLOCK_WEIGHTS", 9)
    for m in lexical.BM25_METHODS:
        run = lexical.bm25_search(index, queries, 5, m)
        assert ranked(run) == whole[m]
    assert ranked(lexical.tfidf_search(lexical.fit_tfidf(docs.where("doc_id is not null")), queries, 5)) == cosine


def test_small_products_do_not_multiply_copies(spark, monkeypatch):
    """``chunk_bytes`` bounds a product; how often a vector travels depends on ``BLOCK_BYTES`` alone."""
    from rankloom.operators import dense

    v = spark.range(60).select(F.col("id").alias("doc_id"), F.expr("transform(sequence(1, 4), i -> sin(id * i + i))").alias("embedding"))
    q = v.select(F.col("doc_id").alias("qid"), "embedding")
    grids, grid = [], dense._grid
    monkeypatch.setattr(dense, "_grid", lambda *a: grids.append(a[-1]) or grid(*a))
    rows = lambda run: sorted((r.qid, r.rank, r.doc_id) for r in run.collect())
    small = rows(dense.knn_search(v, q, 3, assume_normalized=False, chunk_bytes=200))
    assert grids == [(1, 1), (1, 1)]
    monkeypatch.setattr(dense, "FOUND_ROWS", 30)  # ten queries of three results
    assert rows(dense.knn_search(v, q, 3, assume_normalized=False)) == small
    assert grids[2] == (6, 1)
