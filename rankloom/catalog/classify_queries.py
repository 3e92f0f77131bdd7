"""Splits, features, classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import fixtures as fx
from rankloom.catalog import sqlparts as sp
from rankloom.catalog.join_queries import SPLIT
from rankloom.operators import classify as cl
from rankloom.operators.common import store
from rankloom.operators.metrics import classification_scores
from rankloom.plans import studies


def labelled(spark, sf):
    """Texts with the quality label, as far as documents are labelled."""
    quality = fx.table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("category"))
    docs = fx.docs(spark, sf).select("doc_id", "content").join(quality, "doc_id")
    return cl.labelled_texts(docs)


def by_language(spark, sf):
    """Bodies only: the content column would give the language away in its tags."""
    return cl.labelled_texts(fx.raw_docs(spark, sf), text_col="text")


def split(spark, sf):
    return cl.stratified_split(by_language(spark, sf)).select("row_id", "label", "split")


def _split_rows(spark, sf, rows=None):
    rows = by_language(spark, sf) if rows is None else rows
    return store(cl.stratified_split(rows))


def _part(rows, name):
    return rows.where(F.col("split") == name).select("row_id", "text", "label")


def _tfidf_features(max_features=None):
    """Validation features after a fit on the training part, summed per row."""

    def query(spark, sf):
        rows = _split_rows(spark, sf)
        f = cl.fit_features(_part(rows, "train"), max_features=max_features).transform(_part(rows, "val"))
        return f.groupBy("row_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_total"), F.round(F.sum("weight"), 6).alias("weight_total")
        )

    return query


def vocabulary(spark, sf):
    """All terms of the training part with their column numbers."""
    rows = _split_rows(spark, sf)
    return cl.fit_features(_part(rows, "train")).vocabulary.select("term", "idx", "df", "cf")


def count_features(spark, sf):
    rows = _split_rows(spark, sf)
    f = cl.fit_features(_part(rows, "train"), "count").transform(_part(rows, "val"))
    return f.groupBy("row_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_total"), F.sum("weight").cast("bigint").alias("weight_total")
    )


def embedding_features(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = _split_rows(spark, sf)
    model = cl.fit_features(_part(rows, "train"), "embeddings")
    vec = vector_to_array("features")
    return model.vectors(_part(rows, "test")).select("row_id", F.size(vec).alias("dim"), F.round(F.get(vec, F.lit(0)), 6).alias("first"))


def _nb(rows, target, max_features=None):
    model = cl.fit_features(_part(rows, "train"), max_features=max_features)
    train = _part(rows, "train")
    nb = cl.fit_naive_bayes(model.class_sums(), train.select("row_id", "label"), model.vocabulary)
    return nb, nb.votes(model, target)


def _naive_bayes(max_features=None):
    def query(spark, sf):
        rows = _split_rows(spark, sf)
        target = _part(rows, "test")
        nb, votes = _nb(rows, target, max_features)
        return nb.predict(votes, target).join(target.select("row_id", "label"), "row_id")

    return query


def naive_bayes_proba(spark, sf):
    rows = _split_rows(spark, sf)
    target = _part(rows, "test")
    nb, votes = _nb(rows, target)
    return nb.probabilities(votes, target).select("row_id", "category", F.round("p", 6).alias("p"))


def _ml(method, kind="tfidf"):
    def query(spark, sf):
        rows = _split_rows(spark, sf)
        model = cl.fit_features(_part(rows, "train"), kind)
        clf = cl.Classifier(method).fit(store(model.vectors(_part(rows, "train"))))
        return clf.predict(model.vectors(_part(rows, "test"))).select("row_id", "label", "prediction")
    return query


def class_probabilities(spark, sf):
    rows = _split_rows(spark, sf)
    model = cl.fit_features(_part(rows, "train"))
    clf = cl.Classifier("logreg").fit(store(model.vectors(_part(rows, "train"))))
    return clf.predict_proba(model.vectors(_part(rows, "test")))


def ablation(spark, sf):
    """All features with all classifiers on the quality labels, ranked by macro F1.

    The perceptron has a weight per term and hidden unit, so the caller bounds the vocabulary here.
    """
    rows = _split_rows(spark, sf, labelled(spark, sf))
    train = _part(rows, "train")
    models = {kind: cl.fit_features(train, kind, max_features=50_000) for kind in cl.FEATURES}
    # a perceptron over 50,000 terms takes most of the time: forty epochs here, two hundred by default
    table = studies.feature_ablation(rows, models, cl.METHODS, mlp={"max_epochs": 40})
    return table.orderBy(F.col("macro_f1").desc())


def final_refit(spark, sf):
    """Fit on train and validation, report on test; features stay fitted on train."""
    rows = _split_rows(spark, sf, labelled(spark, sf))
    model = cl.fit_features(_part(rows, "train"))
    both = _part(rows, "train").unionByName(_part(rows, "val"))
    clf = cl.Classifier("logreg").fit(store(model.vectors(both)))
    return classification_scores(clf.predict(model.vectors(_part(rows, "test"))).select("label", "prediction"))


def docs_and_queries(spark, sf):
    """One model judged on documents and on titles separately."""
    train = by_language(spark, sf)
    titles = fx.title_queries(spark, sf)
    queries = titles.select(F.concat(F.lit("q"), "qid").alias("row_id"), F.col("content").alias("text"), F.col("category").alias("label"))
    model = cl.fit_features(train)
    nb = cl.fit_naive_bayes(model.class_sums(), train.select("row_id", "label"), model.vocabulary)
    target = train.unionByName(queries)
    predicted = nb.predict(nb.votes(model, target), target).join(target.select("row_id", "label"), "row_id")
    side = F.when(F.startswith("row_id", F.lit("d")), "docs").otherwise("queries")
    return classification_scores(predicted.withColumn("side", side), ["side"])


QUERIES = {
    "c1_stratified_split": split,
    "c2_tfidf_features": _tfidf_features(),
    "c2_tfidf_features_50k": _tfidf_features(50_000),
    "c2_vocabulary": vocabulary,
    "c3_count_features": count_features,
    "c4_embedding_features": embedding_features,
    "c5_naive_bayes": _naive_bayes(),
    "c5_naive_bayes_50k": _naive_bayes(50_000),
    "c6_linear_svm": _ml("svc"),
    "c7_logistic_regression": _ml("logreg"),
    "c8_perceptron": _ml("mlp", "embeddings"),
    "c9_estimator_naive_bayes": _ml("nb", "count"),
    "c10_naive_bayes_proba": naive_bayes_proba,
    "c10_class_probabilities": class_probabilities,
    "c11_feature_ablation": ablation,
    "c12_final_refit": final_refit,
    "c13_docs_and_queries": docs_and_queries,
}

_SRC = "src AS (SELECT 'd' || doc_id AS row_id, body AS text, lang AS label FROM d0)"
_SPLIT = [sp.RAW, _SRC, SPLIT.format(src="src")]
_PARTS = [*_SPLIT] + [f"{n} AS (SELECT row_id, text, label FROM sx WHERE split = '{n}')" for n in ("train", "val", "test")]
_NB = [*_PARTS, sp.naive_bayes("nb", "train", "test")]
def _features(size=None):
    return [
        *_PARTS,
        sp.grams("tg", "train", "row_id", "text"),
        sp.grams("vg", "val", "row_id", "text"),
        sp.vocabulary("v", "tg", size),
        sp.tfidf_weights("w", "vg", "v", "train", "row_id"),
    ]


_SUMMED = "SELECT row_id, count(*) AS n, CAST(sum(idx) AS BIGINT) AS idx_total, round(sum(weight), 6) AS weight_total FROM w JOIN v USING (term) GROUP BY row_id"

ORACLE = {
    "c1_stratified_split": sp.with_(*_SPLIT) + "SELECT row_id, label, split FROM sx",
    "c2_tfidf_features": sp.with_(*_features()) + _SUMMED,
    "c2_tfidf_features_50k": sp.with_(*_features(50000)) + _SUMMED,
    "c2_vocabulary": sp.with_(*_PARTS, sp.grams("tg", "train", "row_id", "text"), sp.vocabulary("v", "tg"))
    + "SELECT term, idx, df, CAST(cf AS BIGINT) AS cf FROM v",
    "c3_count_features": sp.with_(*_features())
    + "SELECT row_id, count(*) AS n, CAST(sum(idx) AS BIGINT) AS idx_total, CAST(sum(tf) AS BIGINT) AS weight_total FROM vg JOIN v USING (term) GROUP BY row_id",
    "c4_embedding_features": sp.with_(*_PARTS, "ct AS (SELECT row_id, text AS content FROM test)", sp.hashed("h", "ct", "row_id"))
    + "SELECT row_id, CAST(64 AS INTEGER) AS dim, round(coalesce(max(v) FILTER (i = 0), 0), 6) AS first FROM ct LEFT JOIN h USING (row_id) GROUP BY row_id",
    "c5_naive_bayes": sp.with_(*_NB) + "SELECT row_id, prediction, label FROM nb_y JOIN test USING (row_id)",
    "c5_naive_bayes_50k": sp.with_(*_PARTS, sp.naive_bayes("nb", "train", "test", size=50000))
    + "SELECT row_id, prediction, label FROM nb_y JOIN test USING (row_id)",
    "c10_naive_bayes_proba": sp.with_(*_NB) + "SELECT row_id, category, round(p, 6) AS p FROM nb_p",
    "c13_docs_and_queries": sp.with_(
        sp.RAW, sp.TITLES, _SRC, "tg0 AS (SELECT row_id, text, label FROM src UNION ALL SELECT 'q' || qid, content, category FROM tq)",
        sp.naive_bayes("nb", "src", "tg0"),
        "y AS (SELECT CASE WHEN row_id LIKE 'd%' THEN 'docs' ELSE 'queries' END AS side, label, prediction FROM nb_y JOIN tg0 USING (row_id))",
        """l AS (SELECT DISTINCT side, label AS c FROM y UNION SELECT DISTINCT side, prediction FROM y),
s AS (SELECT l.side, l.c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS sup, count(*) FILTER (prediction = c) AS pre
  FROM l JOIN y ON y.side = l.side GROUP BY ALL)""",
    ) + """SELECT side, round(sum(tp) * 1.0 / sum(sup), 6) AS accuracy, round(avg(2.0 * tp / (sup + pre)), 6) AS macro_f1,
  round(avg(tp * 1.0 / sup) FILTER (sup > 0), 6) AS balanced_accuracy FROM s GROUP BY side""",
}
