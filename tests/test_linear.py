"""The squared-hinge machine and the other linear models against numpy."""

import threading
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rankloom.operators import classify, linear, perceptron
from rankloom.plans import studies


def problem(n=240, width=12, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(classes, width))
    y = rng.integers(0, classes, n)
    x = centres[y] + rng.normal(size=(n, width)) * 1.5
    x[rng.random(x.shape) < 0.5] = 0
    return x, y


def frame(spark, x, y, dense=False):
    rows = []
    for i, (v, k) in enumerate(zip(x, y)):
        at = np.flatnonzero(v)
        vector = Vectors.dense(v) if dense and i % 2 else Vectors.sparse(len(v), at.tolist(), v[at].tolist())
        rows.append((i, "abcdef"[k], vector))
    return spark.createDataFrame(rows, ["row_id", "label", "features"]).repartition(5)


def newton_svm(x, s, c):
    """One problem by full Newton steps with halving, to the last digit."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    f = lambda w: 0.5 * w @ w + c * (np.maximum(0, 1 - s * (a @ w)) ** 2).sum()
    for _ in range(100):
        inside = s * (a @ w) < 1
        g = w + 2 * c * a[inside].T @ (a[inside] @ w - s[inside])
        if np.linalg.norm(g) < 1e-11:
            break
        step = np.linalg.solve(np.eye(len(w)) + 2 * c * a[inside].T @ a[inside], -g)
        t = 1.0
        while f(w + t * step) > f(w) and t > 1e-8:
            t /= 2
        w = w + t * step
    return w


@pytest.mark.parametrize("classes, dense, c", [(3, False, 1.0), (2, True, 1.0), (4, True, 0.05)])
def test_svm_equals_newton(spark, classes, dense, c):
    x, y = problem(classes=classes)
    df = frame(spark, x, y, dense)
    clf = classify.Classifier("svc", c=c, tol=1e-9).fit(df)
    own = [1] if classes == 2 else range(classes)
    want = np.array([newton_svm(x, np.where(y == k, 1.0, -1.0), c) for k in own])
    assert np.abs(clf._model.coefficients - want).max() < 1e-7
    decisions = np.hstack([x, np.ones((len(x), 1))]) @ want.T
    got = {r.row_id: r for r in clf._model.decisions(clf.predict(df)).collect()}
    for i in range(len(x)):
        assert got[i].decisions == pytest.approx(decisions[i], abs=1e-6)
        best = int(decisions[i][0] > 0) if classes == 2 else int(np.argmax(decisions[i]))
        assert got[i].prediction == "abcdef"[best]


def test_sums_by_groups_equal_direct_sums(spark, monkeypatch):
    x, y = problem()
    df = frame(spark, x, y)
    direct = classify.Classifier("svc").fit(df)._model.coefficients
    monkeypatch.setattr(linear, "DIRECT_BYTES", 0)
    monkeypatch.setattr(linear, "FAN_IN", 2)
    monkeypatch.setattr(linear, "SLICE", 7)
    monkeypatch.setattr(linear, "BLOCK_ENTRIES", 40)
    assert np.abs(classify.Classifier("svc").fit(df)._model.coefficients - direct).max() < 1e-6


def test_svm_refuses_what_it_cannot_do(spark, monkeypatch):
    x, y = problem(40)
    with pytest.raises(ValueError, match="two classes"):
        classify.Classifier("svc").fit(frame(spark, x, np.zeros(40, int)))
    monkeypatch.setattr(linear, "MAX_COEFFICIENTS", 10)
    with pytest.raises(ValueError, match="max_features"):
        classify.Classifier("svc").fit(frame(spark, x, y))


def softmax_loss_gradient(x, y, w, b, classes, c=1.0):
    """Gradient of ``0.5 |w|^2 + c * cross entropy`` (bias free)."""
    z = x @ w.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    r = c * (p - np.eye(classes)[y])
    return np.concatenate([(w + r.T @ x).ravel(), r.sum(axis=0)])


def test_logistic_regression_is_at_the_minimum(spark):
    x, y = problem(classes=3)
    model = classify.Classifier("logreg", tol=1e-10, maxIter=500).fit(frame(spark, x, y))._model
    w, b = model.coefficientMatrix.toArray(), np.array(model.interceptVector.toArray())
    assert np.abs(softmax_loss_gradient(x, y, w, b, 3)).max() < 1e-3


def test_binary_logistic_regression_has_one_weight_vector(spark):
    x, y = problem(classes=2)
    model = classify.Classifier("logreg", tol=1e-10, maxIter=500).fit(frame(spark, x, y))._model
    w, b = model.coefficientMatrix.toArray()[0], float(model.interceptVector[0])
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert model.coefficientMatrix.numRows == 1
    assert np.abs(np.append(w + (p - y) @ x, (p - y).sum())).max() < 1e-3


def test_naive_bayes_probabilities(spark):
    """Counts and smoothed likelihoods by hand, on the estimator behind ``nb``."""
    x = np.abs(problem(60, 5, 3)[0]).round()
    y = problem(60, 5, 3)[1]
    df = frame(spark, x, y)
    got = {r.row_id: r.proba for r in classify.Classifier("nb").fit(df).predict(df).collect()}
    mass = np.array([x[y == k].sum(axis=0) + 1 for k in range(3)])
    prior = np.log((np.bincount(y, minlength=3) + 1) / (len(y) + 3))
    joint = x @ np.log(mass / mass.sum(axis=1, keepdims=True)).T + prior
    p = np.exp(joint - joint.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    for i in range(60):
        assert [got[i][c] for c in "abc"] == pytest.approx(p[i], abs=1e-9)


def test_vocabulary_keeps_all_terms_by_default(spark):
    rows = [(str(i), " ".join(f"t{j}" for j in range(i, i + 5)), "ab"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "row_id string, text string, label string")
    model = classify.fit_features(df)
    terms = [r.term for r in model.vocabulary.orderBy("idx").collect()]
    assert terms == sorted(terms) and len(terms) == model.width == 34 + 33
    few = classify.fit_features(df, max_features=10)
    assert few.width == 10 and [r.idx for r in few.vocabulary.orderBy("term").collect()] == list(range(10))
    lengths = model.transform(df).groupBy("row_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert len(lengths) == 30 and all(r.s == pytest.approx(1.0) for r in lengths)
    assert model.transform(df, keep=["label"]).columns == ["row_id", "label", "idx", "weight"]


def dense_batches(blocks, width):
    """The stored mini-batches by task, as dense matrices."""
    out = {}
    for r in blocks.collect():
        ptr, idx, val, y = (np.frombuffer(r[c], t) for c, t in (("ptr", np.int64), ("idx", np.int32), ("val", float), ("y", np.int64)))
        x = np.zeros((len(y), width))
        x[np.repeat(np.arange(len(y)), np.diff(ptr)), idx] = val
        out.setdefault(r["part"], []).append((x, y))
    return out


def adam_by_hand(parts, w, epochs, seed, alpha=1e-4):
    """Every task from the mean of all, one epoch at a time; dense products and the textbook update."""
    m, v, t, losses = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0.0, []
    w = [a.copy() for a in w]
    for epoch in range(epochs):
        ends, total, n_all = [], 0.0, 0
        for part, batches in parts.items():
            W, M, V, T = [a.copy() for a in w], [a.copy() for a in m], [a.copy() for a in v], t
            for i in perceptron.epoch_order(seed, epoch, part, len(batches)):
                x, y = batches[i]
                n = len(y)
                h = np.maximum(x @ W[0] + W[1], 0)
                z = h @ W[2] + W[3]
                p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
                total += n * (-np.log(p[np.arange(n), y]).mean() + alpha / 2 * ((W[0] ** 2).sum() + (W[2] ** 2).sum()) / n)
                d = p - np.eye(p.shape[1])[y]
                b = (d @ W[2].T) * (h > 0)
                g = [(x.T @ b + alpha * W[0]) / n, b.mean(axis=0), (h.T @ d + alpha * W[2]) / n, d.mean(axis=0)]
                T += 1
                for k in range(4):
                    M[k] = 0.9 * M[k] + 0.1 * g[k]
                    V[k] = 0.999 * V[k] + 0.001 * g[k] ** 2
                    W[k] = W[k] - 1e-3 * np.sqrt(1 - 0.999**T) / (1 - 0.9**T) * M[k] / (np.sqrt(V[k]) + 1e-8)
            rows = sum(len(y) for _, y in batches)
            ends.append((rows, W, M, V, T))
            n_all += rows
        mean = lambda j: [sum(e[0] * e[j][k] for e in ends) / n_all for k in range(4)]
        w, m, v, t = mean(1), mean(2), mean(3), sum(e[0] * e[4] for e in ends) / n_all
        losses.append(total / n_all)
    return w, losses


@pytest.mark.parametrize("tasks, rounds", [(1, 4), (1, 1), (3, 1)])
def test_perceptron_equals_adam_by_hand(spark, tasks, rounds):
    x, y = problem(n=250)
    df = frame(spark, x, y, dense=True).select(F.expr("ascii(label) - 97").alias("_y"), "features")
    options = {"hidden": 7, "batch": 40, "seed": 5, "tasks": tasks}
    model = perceptron.fit_perceptron(df, list("abc"), 12, max_epochs=12, epochs_per_round=rounds, **options)
    parts = dense_batches(perceptron.cut_batches(df, tasks, 40, 5), 12)
    assert sum(len(y) for b in parts.values() for _, y in b) == 250 and len(parts) == tasks
    w, losses = adam_by_hand(parts, perceptron.start_weights(12, 7, 3, 5), 12, 5)
    assert model.losses == pytest.approx(losses, abs=1e-10)
    assert all(np.abs(a - b).max() < 1e-10 for a, b in zip(model.weights, w))


def test_perceptron_learns_what_no_line_can(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (600, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = frame(spark, x, y, dense=True)
    clf = classify.Classifier("mlp", rate=0.02).fit(df)
    rows = clf.predict(df).collect()
    assert np.mean([r.prediction == r.label for r in rows]) > 0.95 and len(clf._model.losses) <= 200
    assert all(sum(r.proba.values()) == pytest.approx(1.0) and r.prediction == max(r.proba, key=r.proba.get) for r in rows)
    assert classify.Classifier("svc").fit(df).predict(df).where("prediction = label").count() < 400


def csr_batch(x, y):
    rows, columns = np.nonzero(x)
    ptr = np.concatenate([[0], np.cumsum((x != 0).sum(axis=1))])
    return perceptron.Batch(ptr, columns.astype(np.int32), x[rows, columns], y, x.shape[1])


def test_a_step_makes_no_array_as_wide_as_the_vocabulary():
    rng = np.random.default_rng(3)
    x = np.zeros((40, 20_000))
    x[:, :3] = 1.0  # frequent terms, rare ones, a row without any
    x[rng.integers(0, 40, 400), rng.integers(0, 20_000, 400)] = rng.normal(size=400)
    x[7] = 0
    y = rng.integers(0, 2, 40)
    w = perceptron.start_weights(20_000, 50, 2, 1)
    state = {"w": [a.copy() for a in w], "m": [np.zeros_like(a) for a in w], "v": [np.zeros_like(a) for a in w], "t": 0.0}
    batches = [csr_batch(x, y)]
    tracemalloc.start()
    losses = [perceptron.adam_epoch(state, batches, np.arange(1), 1e-4, 1e-3) for _ in range(3)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want, by_hand = adam_by_hand({0: [(x, y)]}, w, 3, 1)
    assert losses == pytest.approx(by_hand, abs=1e-12) and all(np.abs(a - b).max() < 1e-12 for a, b in zip(state["w"], want))
    assert peak < w[0].nbytes / 4


def test_products_of_batches():
    rng = np.random.default_rng(4)
    for x in (rng.normal(size=(30, 9)), np.where(rng.random((30, 60)) < 0.2, 1.5, 0.0), np.zeros((4, 5)), np.eye(6)):
        batch, w, delta = csr_batch(x, np.zeros(len(x), int)), rng.normal(size=(x.shape[1], 7)), rng.normal(size=(len(x), 7))
        out = np.zeros_like(w)
        for columns, sums in batch.back(delta):
            assert (np.diff(columns) > 0).all()
            out[columns] += sums
        assert batch.times(w) == pytest.approx(x @ w, abs=1e-12) and out == pytest.approx(x.T @ delta, abs=1e-12)
    assert csr_batch(np.ones((3, 2)), np.zeros(3, int)).dense is not None
    twice = perceptron.Batch(np.array([0, 2, 4]), np.array([1, 1, 0, 1], np.int32), np.ones(4), np.zeros(2, int), 2)
    assert twice.times(np.eye(2)).tolist() == [[0, 2], [1, 1]]


def test_states_of_many_tasks_are_added_the_same_by_tasks_and_driver(spark, monkeypatch):
    x, y = problem(n=90)
    df = frame(spark, x, y).select(F.expr("ascii(label) - 97").alias("_y"), "features")
    fit = lambda: perceptron.fit_perceptron(df, list("abc"), 12, hidden=5, batch=20, tasks=3, max_epochs=3)
    here = fit()
    monkeypatch.setattr(perceptron, "DIRECT_BYTES", 0)
    there = fit()
    assert here.losses == pytest.approx(there.losses, abs=1e-12)
    assert all(np.abs(a - b).max() < 1e-12 for a, b in zip(here.weights, there.weights))


def test_an_ablation_fits_all_pairs_beside_each_other(spark, monkeypatch):
    class Given:
        def vectors(self, df):
            return df

    x, y = problem(n=120, classes=2)
    df = frame(spark, np.abs(x), y).withColumn("split", F.when(F.col("row_id") % 4 == 0, "val").otherwise("train"))
    one_by_one = {m: classify.Classifier(m).fit(df.where("split = 'train'")).predict(df.where("split = 'val'")) for m in ("nb", "svc")}
    want = {m: p.where("label = prediction").count() / p.count() for m, p in one_by_one.items()}
    together, fit = threading.Barrier(3), classify.Classifier.fit

    def waiting(self, *args):
        together.wait(60)
        return fit(self, *args)

    monkeypatch.setattr(classify.Classifier, "fit", waiting)
    found = studies.feature_ablation(df, {"count": Given(), "embeddings": Given()}, ["nb", "svc"]).collect()
    assert [(r.features, r.classifier) for r in found] == [("count", "nb"), ("count", "svc"), ("embeddings", "svc")]
    assert all(r.accuracy == pytest.approx(want[r.classifier], abs=1e-6) for r in found)
    assert studies.feature_ablation(df, {}, ["nb"]) is None


def test_tables_too_large_to_broadcast_give_the_same(spark, monkeypatch):
    rows = [(str(i), "common " + " ".join(f"t{j % 17}" for j in range(i, i + 6)), "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id string, text string, label string")

    def probabilities():
        model = classify.fit_features(df)
        nb = classify.fit_naive_bayes(model.transform(df, keep=["label"]), df.select("row_id", "label"), model.vocabulary)
        return {(r.row_id, r.category): round(r.p, 9) for r in nb.probabilities(model.transform(df), df).collect()}

    want = probabilities()
    monkeypatch.setattr(classify, "fits_broadcast", lambda table: False)
    assert probabilities() == want and len(want) == 180
