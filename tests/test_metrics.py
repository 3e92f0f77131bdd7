"""Metric corner cases, splits, classifiers, result lists, judgments."""

import json

import pytest
from pyspark.sql import functions as F

from rankloom.operators import classify, metrics, sampling, submission
from rankloom.plans.config import CategoryPlan, Fusion, HybridPlan, Rerank
from rankloom.sources import corpus


def run_of(spark, rows):
    return spark.createDataFrame(rows, "qid long, rank int, doc_id long")


def test_ranking_metrics_corner_cases(spark):
    run = run_of(spark, [(1, 1, 7), (1, 2, 7), (1, 3, 8), (2, 1, 9)])
    qrels = spark.createDataFrame([(1, 7), (1, 8), (1, 99)], "qid long, doc_id long")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "qid long")
    row = metrics.evaluate(run, qrels, queries, [4]).first()
    assert row["precision"] == pytest.approx(2 / 4 / 3, abs=1e-6)
    assert row["recall"] == pytest.approx(2 / 3 / 3, abs=1e-6)
    assert row["mrr"] == pytest.approx(1 / 3, abs=1e-6)


def test_unjudged_query_is_an_error(spark):
    queries = spark.createDataFrame([(1,), (2,)], "qid long")
    with pytest.raises(ValueError, match="not judged"):
        metrics.check_judged(queries, queries.where("qid = 1"))
    metrics.check_judged(queries, queries)


def test_classification_metrics(spark):
    pairs = [("a", "a"), ("a", "z"), ("b", "a"), ("c", "c")]
    pred = spark.createDataFrame(pairs, "label string, prediction string")
    row = metrics.classification_scores(pred).first()
    assert row["accuracy"] == 0.5
    assert row["macro_f1"] == pytest.approx((0.5 + 0 + 1 + 0) / 4)
    assert row["balanced_accuracy"] == pytest.approx((0.5 + 0 + 1) / 3, abs=1e-6)
    cells = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(pred).collect()}
    assert len(cells) == 9 and cells[("a", "a")] == 1 and cells[("a", "b")] == 0


def test_missing_prediction_is_an_error(spark):
    truth = spark.createDataFrame([(1, "a"), (2, "b")], "qid long, category string")
    pred = spark.createDataFrame([(1, "a")], "qid long, prediction string")
    with pytest.raises(Exception, match="missing"):
        metrics.query_category_accuracy(truth, pred).collect()


def test_split_is_disjoint_and_stratified(spark):
    rows = spark.range(400).select(F.col("id").alias("row_id"), F.when(F.col("id") < 300, "a").otherwise("b").alias("label"))
    counts = {(r["label"], r["split"]): r["count"] for r in classify.stratified_split(rows).groupBy("label", "split").count().collect()}
    assert counts == {
        ("a", "test"): 45, ("a", "val"): 45, ("a", "train"): 210, ("b", "test"): 15, ("b", "val"): 15, ("b", "train"): 70,
    }


@pytest.mark.parametrize("method", ["nb", "svc", "logreg"])
def test_classifiers_learn_an_easy_problem(spark, method):
    rows = [(str(i), "red apple fruit" if i % 2 else "blue sea water", "fruit" if i % 2 else "sea") for i in range(30)]
    df = spark.createDataFrame(rows, "row_id string, text string, label string")
    model = classify.fit_features(df, "tfidf", max_features=50)
    clf = classify.Classifier(method).fit(model.vectors(df))
    assert clf.classes == ["fruit", "sea"]
    out = clf.predict(model.vectors(df))
    assert out.where("prediction = label").count() == 30
    assert (clf.predict_proba(model.vectors(df)) is None) == (method == "svc")


def test_classifier_misuse():
    with pytest.raises(ValueError):
        classify.Classifier("forest")
    with pytest.raises(RuntimeError):
        classify.Classifier("nb").classes


def test_submission_checks(spark):
    run = run_of(spark, [(1, 1, 5), (1, 2, 5), (1, 3, 6), (1, 4, 7)])
    q = spark.createDataFrame([(1,)], "qid long")
    row = submission.make_submission(run, q, 2).first()
    assert json.loads(row["relevant_doc_ids"]) == ["5", "6"] and row["category"] == "?"
    with pytest.raises(Exception, match="fewer than 4"):
        submission.make_submission(run, q, 4).collect()
    submission.verify_submission(submission.make_submission(run, q, 3), 3)
    with pytest.raises(ValueError):
        submission.verify_submission(submission.make_submission(run, q, 3), 2)


def test_judgment_formats(spark):
    texts = [
        ('{"1":{"relevant_doc_ids":[1,"2",{"doc_id":3},{"id":"x"},null,2],"category":"a"},"2":["9","9"],"3":{"relevant":[]},"4":5}',),
        ('[{"query_id":7,"doc_ids":["a"]},{"qid":"8","relevant":["b",{"docid":5}]},{"x":1},3]',),
    ]
    parsed = corpus.parse_judgments(spark.createDataFrame(texts, "value string"))
    pairs = {(r["qid"], r["doc_id"]) for r in corpus.judgment_pairs(parsed).collect()}
    assert pairs == {("1", "1"), ("1", "2"), ("1", "3"), ("1", "x"), ("2", "9"), ("4", "5"), ("7", "a"), ("8", "b"), ("8", "5")}
    assert {r["qid"] for r in corpus.judged_queries(parsed).collect()} == {"1", "2", "3", "4", "7", "8"}
    with pytest.raises(Exception, match="no category"):
        corpus.judgment_categories(parsed).collect()
    with pytest.raises(Exception, match="unsupported judgment"):
        corpus.parse_judgments(spark.createDataFrame([("3",)], "value string")).collect()


def test_quality_gate(spark):
    bad = spark.createDataFrame([("two words",), ("� a b c",), (" ",), (None,), ("fine text here",)], "content string")
    report = sampling.content_quality({"x": bad})
    row = report.first()
    assert (row["is_null"], row["is_empty"], row["too_short"], row["bad_encoding"]) == (1, 1, 1, 1)
    with pytest.raises(ValueError):
        sampling.require_clean_content(report)


def test_config_checks():
    with pytest.raises(ValueError):
        HybridPlan(fusion=Fusion(offset=0))
    with pytest.raises(ValueError):
        CategoryPlan(rerank=Rerank("soft_boost"))
    with pytest.raises(ValueError):
        Fusion(offset=1, weights={"other": 1.0})


def test_groups_without_rows_and_unjudged_queries(spark):
    queries = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "qid long, category string")
    runs = spark.createDataFrame([("m", "a", 1, 1, 5)], "method string, category string, qid long, rank int, doc_id long")
    qrels = spark.createDataFrame([(1, 5), (2, 6)], "qid long, doc_id long")
    rows = metrics.evaluate(runs, qrels, queries, [3], ["method", "category"]).collect()
    assert {(r.method, r.category): r.mrr for r in rows} == {("m", "a"): 1.0, ("m", "b"): 0.0, ("m", None): 0.0} and len(rows) == 3
    rows = metrics.evaluate(runs.limit(0).drop("method", "category"), qrels, queries, [3, 5]).collect()
    assert {(r.k, r.precision, r.recall, r.mrr) for r in rows} == {(3, 0.0, 0.0, 0.0), (5, 0.0, 0.0, 0.0)}
    with pytest.raises(ValueError, match="not judged"):
        metrics.evaluate(runs, qrels, queries, [3], ["method"], judged=qrels.select("qid").where("qid = 1"))
    assert metrics.evaluate(runs, qrels, queries, [3], ["method"], judged=queries.select("qid")).count() == 1
