"""Ranking and classification metrics, all as grouped aggregates over long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.functions.text import id_text


def check_judged(queries: DataFrame, judged: DataFrame) -> None:
    """Every query must be judged; an empty judgment is fine, an absent one is not."""
    missing = queries.join(judged.select("qid"), "qid", "left_anti").agg(
        F.count(F.lit(1)).alias("n"), F.min(id_text("qid")).alias("first")
    ).first()
    if missing["n"]:
        raise ValueError(f"{missing['n']} query ids are not judged, for example {missing['first']}")


def mark_relevant(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Run rows with ``is_rel`` (1 or 0)."""
    marked = run.join(qrels.select("qid", "doc_id", F.lit(1).alias("is_rel")), ["qid", "doc_id"], "left")
    return marked.withColumn("is_rel", F.coalesce("is_rel", F.lit(0)))


def per_query(
    runs: DataFrame, qrels: DataFrame, k_values: Sequence[int], group: Sequence[str] = ()
) -> DataFrame:
    """``(group…, k, qid, precision, recall, mrr)`` for the queries that have run rows.

    A document listed twice counts once, at its first rank.
    """
    if not k_values or any(k <= 0 for k in k_values):
        raise ValueError(f"cutoffs are positive numbers of rows, not {list(k_values)}")
    first = (
        mark_relevant(runs.select(*group, "qid", "rank", "doc_id"), qrels)
        .groupBy(*group, "qid", "doc_id")
        .agg(F.min("rank").alias("rank"), F.max("is_rel").alias("is_rel"))
    )
    at_k = first.withColumn("k", F.explode(F.array(*[F.lit(int(k)) for k in sorted(set(k_values))])))
    inside = (F.col("rank") <= F.col("k")) & (F.col("is_rel") == 1)
    hits = at_k.groupBy(*group, "k", "qid").agg(
        F.count_if(inside).alias("hits"), F.min(F.when(inside, F.col("rank"))).alias("first_rank")
    )
    n_rel = qrels.groupBy("qid").agg(F.count_distinct("doc_id").alias("n_rel"))
    return hits.join(n_rel, "qid", "left").select(
        *group,
        "k",
        "qid",
        (F.col("hits") / F.col("k")).alias("precision"),
        F.coalesce(F.col("hits") / F.col("n_rel"), F.lit(0.0)).alias("recall"),
        F.coalesce(1 / F.col("first_rank"), F.lit(0.0)).alias("mrr"),
    )


def evaluate(
    runs: DataFrame,
    qrels: DataFrame,
    queries: DataFrame,
    k_values: Sequence[int],
    group: Sequence[str] = (),
    digits: int | None = 6,
    judged: DataFrame | None = None,
) -> DataFrame:
    """Mean precision, recall and MRR per group and cutoff over **all** ``queries``.

    Queries without run rows or without relevant documents score zero and stay in
    the mean. With ``group`` columns that ``queries`` also has (a category), the mean
    is over that group's queries, and a group of queries without run rows scores
    zero under every value of the other group columns. Without ``group`` an empty run
    scores zero. ``judged`` lists the queries that have a judgment, an empty one too;
    where given, a query outside it is an error.
    """
    if judged is not None:
        check_judged(queries, judged)
    measures = ("precision", "recall", "mrr")
    sums = per_query(runs, qrels, k_values, group).groupBy(*group, "k").agg(*[F.sum(m).alias(m) for m in measures])
    shared = [g for g in group if g in queries.columns]
    own = [g for g in group if g not in shared]
    sizes = queries.groupBy(*shared).agg(F.count(F.lit(1)).alias("_n"))
    if own:  # methods or settings: as many as were compared
        compared = runs.agg(F.collect_set(F.struct(*own))).scalar()
        sizes = sizes.withColumn("_g", F.explode(compared)).select("*", *[F.col("_g")[g].alias(g) for g in own])
    cutoffs = F.array(*[F.lit(int(k)) for k in sorted(set(k_values))])
    floor = sizes.select(*group, F.explode(cutoffs).alias("k"), *[F.lit(0.0).alias(m) for m in measures], "_n")
    both = sums.withColumn("_n", F.lit(0).cast("long")).unionByName(floor)
    means = both.groupBy(*group, "k").agg(*[F.sum(m).alias(m) for m in measures], F.sum("_n").alias("_n")).where("_n > 0")
    out = means.select(*group, "k", *[(F.col(m) / F.col("_n")).alias(m) for m in measures])
    if digits is None:
        return out
    return out.select(*group, "k", *[F.round(m, digits).alias(m) for m in measures])


def mean_retrieval_score() -> Column:
    return (F.col("precision") + F.col("recall") + F.col("mrr")) / 3


def composite_score(category_accuracy: Column) -> Column:
    return (F.col("precision") + F.col("recall") + F.col("mrr") + category_accuracy) * 0.25


def confusion_counts(pred: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(group…, label, prediction, n)``: the only pass over the predictions."""
    return pred.groupBy(*group, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def label_scores(pred: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(group…, label, tp, support, predicted, precision, recall, f1)`` over true and predicted labels."""
    counts = confusion_counts(pred, group)
    both = F.array(
        F.struct(F.col("label").alias("l"), F.lit(1).alias("t"), F.lit(0).alias("p")),
        F.struct(F.col("prediction").alias("l"), F.lit(0).alias("t"), F.lit(1).alias("p")),
    )
    sides = counts.select(*group, "n", (F.col("label") == F.col("prediction")).alias("ok"), F.explode(both).alias("s"))
    per_label = sides.groupBy(*group, F.col("s.l").alias("label")).agg(
        F.sum(F.when(F.col("ok") & (F.col("s.t") == 1), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.col("n") * F.col("s.t")).alias("support"),
        F.sum(F.col("n") * F.col("s.p")).alias("predicted"),
    )
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    return per_label.select(
        *group,
        "label",
        "tp",
        "support",
        "predicted",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def classification_scores(pred: DataFrame, group: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Accuracy, macro F1 and balanced accuracy per group."""
    scores = label_scores(pred, group)
    return scores.groupBy(*group).agg(
        F.round(F.sum("tp") / F.sum("support"), digits).alias("accuracy"),
        F.round(F.avg("f1"), digits).alias("macro_f1"),
        F.round(F.avg(F.when(F.col("support") > 0, F.col("recall"))), digits).alias("balanced_accuracy"),
    )


def accuracy(pred: DataFrame) -> DataFrame:
    return classification_scores(pred).select("accuracy")


def macro_f1(pred: DataFrame) -> DataFrame:
    return classification_scores(pred).select("macro_f1")


def balanced_accuracy(pred: DataFrame) -> DataFrame:
    return classification_scores(pred).select("balanced_accuracy")


def classification_report(pred: DataFrame, digits: int = 6) -> DataFrame:
    """One row per label plus accuracy, macro and weighted averages."""
    s = label_scores(pred)
    per_label = s.select("label", "precision", "recall", "f1", "support")
    total = F.sum("support")
    acc = F.sum("tp") / total
    accuracy_row = s.agg(acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), total.alias("support"))
    macro = s.agg(*[F.avg(m).alias(m) for m in ("precision", "recall", "f1")], total.alias("support"))
    weighted = s.agg(
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in ("precision", "recall", "f1")],
        total.alias("support"),
    )
    out = per_label
    for name, row in (("accuracy", accuracy_row), ("macro avg", macro), ("weighted avg", weighted)):
        out = out.unionByName(row.withColumn("label", F.lit(name)))
    return out.select("label", *[F.round(m, digits).alias(m) for m in ("precision", "recall", "f1")], "support")


def confusion_matrix(pred: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """All cells ``(label, prediction, n)`` over the label list, zeros included.

    The default list is the labels that occur as truth; other pairs are left out.
    """
    if labels is None:
        listed = pred.agg(F.sort_array(F.collect_set("label")).alias("l")).scalar()
    else:
        listed = F.array(*[F.lit(x) for x in labels])
    rows = pred.select("label").distinct().where(F.array_contains(listed, F.col("label"))) if labels is None else (
        pred.sparkSession.range(1).select(F.explode(listed).alias("label"))
    )
    grid = rows.select("label", F.explode(listed).alias("prediction"))
    return grid.join(confusion_counts(pred), ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def query_category_accuracy(truth: DataFrame, predictions: DataFrame, digits: int = 6) -> DataFrame:
    """Share of queries with the right category; no truth means the query is ignored.

    ``truth(qid, category)`` without a prediction is an error.
    """
    joined = truth.select("qid", "category").join(predictions.select("qid", "prediction", F.lit(1).alias("_p")), "qid", "left")
    hit = F.when(F.col("_p").isNull(), F.raise_error(F.lit("a predicted category is missing"))).otherwise(
        F.col("category").eqNullSafe(F.col("prediction")).cast("int")
    )
    return joined.agg(F.round(F.coalesce(F.avg(hit), F.lit(0.0)), digits).alias("query_category_accuracy"))


def evaluate_with_category(
    runs: DataFrame,
    qrels: DataFrame,
    queries: DataFrame,
    k_values: Sequence[int],
    truth: DataFrame,
    predictions: DataFrame,
    group: Sequence[str] = (),
) -> DataFrame:
    """Ranking metrics with the query-category accuracy beside them."""
    acc = query_category_accuracy(truth, predictions).scalar()
    return evaluate(runs, qrels, queries, k_values, group).withColumn("query_category_accuracy", acc)
