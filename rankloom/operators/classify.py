"""Text features, splits and category classifiers.

N-grams are counted and weighed in blocks of rows (``gram_blocks``); features are ``(row_id, idx, weight)`` until an
estimator needs a vector, Naive Bayes takes sums of the blocks. The vocabulary keeps all terms unless the caller asks for the ``max_features`` most frequent; it is numbered by
ranges of terms and prefix sums and broadcast where its measured size allows, so it may grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rankloom.operators.common import fits_broadcast, global_position, hash_rank, join_heavy, materialise, store
from rankloom.operators.dense import encode_texts
from rankloom.operators.gram_blocks import as_entries, as_sums, as_votes, count_blocks, gram_stats, number_names, weigh_blocks
from rankloom.operators.lexical import smoothed_idf
from rankloom.operators.linear import fit_svm, pack
from rankloom.operators import wide
from rankloom.operators.perceptron import fit_perceptron

# --- fixed values -----------------------------------------------------------
RANDOM_SEED = 42
NGRAM_RANGE = (1, 2)
VAL_SIZE = 0.15
TEST_SIZE = 0.15
METHODS = ("nb", "svc", "logreg", "mlp")
FEATURES = ("tfidf", "count", "embeddings")
NB_ALPHA = 1.0
# ----------------------------------------------------------------------------

MIN_ROWS_PER_TASK = 5_000
WIDE_PARAMS = {"c", "tol", "max_newton", "regParam", "maxIter", "smoothing"}  # what the distributed fits know
MAX_VECTOR = (1 << 31) - 1  # an ML vector counts its entries in 32 bits


def labelled_texts(docs: DataFrame, queries: DataFrame | None = None, text_col: str = "content") -> DataFrame:
    """Documents and, where given, labelled queries as ``(row_id, text, label)``."""
    rows = docs.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("row_id"),
        F.col(text_col).alias("text"),
        F.col("category").alias("label"),
    )
    if queries is None:
        return rows
    extra = queries.select(
        F.concat(F.lit("q"), F.col("qid").cast("string")).alias("row_id"),
        F.col(text_col).alias("text"),
        F.col("category").alias("label"),
    )
    return rows.unionByName(extra)


def stratified_split(
    df: DataFrame,
    label: str = "label",
    id_col: str = "row_id",
    val_size: float = VAL_SIZE,
    test_size: float = TEST_SIZE,
    seed: int = RANDOM_SEED,
) -> DataFrame:
    """Add ``split`` (train, val, test) with equal shares inside every label.

    Rows are ordered by a seeded hash; the rank is exact although no task ever
    holds a whole label (see ``hash_rank``).
    """
    if not (0 < val_size < 1 and 0 < test_size < 1 and val_size + test_size < 1):
        raise ValueError("split sizes must be fractions that leave a training part")
    ranked = hash_rank(df, label, id_col, seed)
    n_test = F.round(F.col("group_size") * test_size)
    n_val = F.round((F.col("group_size") - n_test) * (val_size / (1 - test_size)))
    split = (
        F.when(F.col("rn") <= n_test, "test").when(F.col("rn") <= n_test + n_val, "val").otherwise("train")
    )
    return ranked.withColumn("split", split).drop("rn", "group_size")


def _join_terms(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows with what a table knows of their terms. A table too large to broadcast is shuffled once: common terms are
    joined where their rows are, so neither side is repeated."""
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), key)
    return join_heavy(store(rows), table, key)


@dataclass(frozen=True)
class FeatureModel:
    """Vocabulary ``(term, idx, df, cf)`` of the training rows; ``width`` is its size, ``training`` their counted blocks,
    ``numbered`` what the vocabulary knows of the n-grams of these."""

    kind: str
    vocabulary: DataFrame | None
    n_rows: int
    width: int
    ngram_range: tuple[int, int]
    sublinear_tf: bool = True
    encoder: dict = field(default_factory=dict)
    training: DataFrame | None = field(default=None, repr=False)
    numbered: DataFrame | None = field(default=None, repr=False)

    def _known(self, blocks: DataFrame) -> DataFrame:
        """The n-grams of the blocks with what the vocabulary has on them."""
        names = blocks.where(F.col("_code").isNotNull()).select("_b", "_code", F.col("_term").alias("term"))
        table = self.vocabulary.select("term", "idx", "df")
        if fits_broadcast(table):
            return names.join(F.broadcast(table), "term")
        if fits_broadcast(names):
            return table.join(F.broadcast(names), "term")
        return names.join(table, "term")

    def _weighed(self, blocks: DataFrame, known: DataFrame, keys: Sequence[str], fields: list, form, logps: Sequence[Column] = ()) -> DataFrame:
        """``form`` of the blocks' weighed rows; ``logps`` of a term go along where given."""
        idf = smoothed_idf(F.lit(self.n_rows), F.col("df")).alias("idf")
        known = known.select("_b", "_code", "idx", idf, *([F.array(*logps).alias("logps")] if logps else []))
        sublinear = None if self.kind == "count" else self.sublinear_tf
        return weigh_blocks(blocks, known, keys, T.StructType(fields), form, sublinear)

    def entries(self, df: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
        """``(row_id, keep…, entries)``: a row's known terms as an array of ``(idx, weight)``."""
        keys = ["row_id", *keep]
        pair = T.StructType([T.StructField("idx", T.LongType()), T.StructField("weight", T.DoubleType())])
        blocks = count_blocks(df, text_col, self.ngram_range, keep)
        return self._weighed(blocks, self._known(blocks), keys, [*_fields(df, keys), T.StructField("entries", T.ArrayType(pair))], as_entries)

    def class_sums(self, label: str = "label") -> DataFrame:
        """``(label, idx, weight)``: the training rows' weights, summed by label inside every block."""
        fields = [*_fields(self.training, [label]), T.StructField("idx", T.LongType()), T.StructField("weight", T.DoubleType())]
        known = self._known(self.training) if self.numbered is None else self.numbered
        return self._weighed(self.training, known, ["row_id", label], fields, as_sums)

    def transform(self, df: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
        """Long features ``(row_id, keep…, idx, weight)``; rows without known terms have none."""
        rows = self.entries(df, text_col, keep)
        return rows.select("row_id", *keep, F.explode("entries").alias("_e")).select("row_id", *keep, "_e.idx", "_e.weight")

    def votes(self, df: DataFrame, table: DataFrame, logps: Sequence[Column], text_col: str = "text") -> DataFrame:
        """``(row_id, votes)``: per class the sum of a row's weights times ``logps`` of its terms in ``table(idx, …)``."""
        fields = [*_fields(df, ["row_id"]), T.StructField("votes", T.ArrayType(T.DoubleType()))]
        blocks = count_blocks(df, text_col, self.ngram_range)
        # the words are left behind before the sums of classes come in
        known = store(self._known(blocks).select("_b", "_code", "idx", "df"))
        known = table.join(F.broadcast(known), "idx") if fits_broadcast(known) else table.join(known, "idx")
        return self._weighed(blocks, known, ["row_id"], fields, as_votes, logps)

    def vectors(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """``df`` with an ML ``features`` vector; rows without known terms get an empty one."""
        if self.kind == "embeddings":
            encoded = encode_texts(df, text_col, **self.encoder)
            return encoded.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))).drop("embedding")
        if self.width > MAX_VECTOR:
            raise ValueError(f"{self.width} terms are no vector: give max_features, or use the Naive Bayes that joins terms")
        rows = self.entries(df, text_col).select("row_id", F.sort_array("entries").alias("_e"))
        joined = df.join(rows, "row_id", "left")
        return joined.withColumn("features", sparse_vector("_e", self.width)).drop("_e")


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def sparse_vector(entries: Column | str, size: int) -> Column:
    """ML vector from sorted ``(idx, weight)`` entries, built in the JVM.

    The vector type reads its own struct form, so a JSON round trip replaces a
    row-at-a-time Python function.
    """
    e = F.col(entries) if isinstance(entries, str) else entries
    body = F.struct(
        F.lit(0).alias("type"),
        F.lit(size).alias("size"),
        F.coalesce(F.transform(e, lambda x: x["idx"].cast("int")), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.transform(e, lambda x: x["weight"]), F.array().cast("array<double>")).alias("values"),
    )
    holder = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(body.alias("v"))), holder)["v"]


def fit_features(
    train: DataFrame,
    kind: str = "tfidf",
    text_col: str = "text",
    max_features: int | None = None,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    sublinear_tf: bool = True,
    **encoder,
) -> FeatureModel:
    """Fit on training rows only: all terms, or the ``max_features`` most frequent, ties in term order."""
    if kind not in FEATURES:
        raise ValueError(f"feature method must be one of {FEATURES}, not {kind!r}")
    if kind == "embeddings":
        return FeatureModel(kind, None, 0, encoder.get("dim", 0), ngram_range, encoder=encoder)
    blocks = count_blocks(train, text_col, ngram_range, [c for c in ("label",) if c in train.columns])
    if max_features is None:
        numbered = number_names(blocks)
        vocabulary = numbered.where("_first").select("term", "idx", "df", "cf")
    else:
        numbered = None
        stats = gram_stats(blocks).orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features)
        # column numbers follow term order
        vocabulary = global_position(stats, "term", "idx")
    return FeatureModel(kind, vocabulary, train.count(), vocabulary.count(), ngram_range, sublinear_tf, training=blocks, numbered=numbered)


@dataclass(frozen=True)
class NaiveBayesModel:
    """Multinomial Naive Bayes in SQL: smoothed term likelihoods, empirical prior."""

    mass: DataFrame  # ``(idx, mass)``: of every term of the vocabulary the smoothed mass in every class
    classes: list
    totals: list[float]
    prior: DataFrame  # (category, logprior)

    @property
    def _logps(self) -> list[Column]:
        return [F.ln(F.col("mass")[i] / F.lit(t)) for i, t in enumerate(self.totals)]

    @property
    def likelihood(self) -> DataFrame:
        """``(idx, category, logp)``"""
        pairs = F.array(*[F.struct(F.lit(c).alias("category"), p.alias("logp")) for c, p in zip(self.classes, self._logps)])
        return self.mass.select("idx", F.explode(pairs).alias("_l")).select("idx", "_l.category", "_l.logp")

    def votes(self, model: FeatureModel, df: DataFrame, text_col: str = "text") -> DataFrame:
        """``(row_id, category, v)``: what the terms of every text add to a class, as ``scores`` takes it.

        The texts' features are summed where they are weighed and never become rows.
        """
        summed = model.votes(df, self.mass, self._logps, text_col)
        named = summed.select("row_id", F.posexplode("votes").alias("_c", "v"))
        return named.select("row_id", F.get(F.array(*[F.lit(c) for c in self.classes]), F.col("_c")).alias("category"), "v")

    def scores(self, features: DataFrame, rows: DataFrame) -> DataFrame:
        """Joint log likelihood ``(row_id, category, jll)`` for every row and class; ``features`` are long or ``votes``."""
        classes = self.prior.agg(F.collect_list(F.struct("category", "logprior")).alias("c")).scalar()
        base = rows.select("row_id", F.explode(classes).alias("_c")).select("row_id", "_c.category", "_c.logprior")
        votes = features
        if "v" not in features.columns:
            voting = _join_terms(features.select("row_id", "idx", "weight"), self.likelihood, "idx")
            votes = voting.groupBy("row_id", "category").agg(F.sum(F.col("weight") * F.col("logp")).alias("v"))
        return base.join(votes, ["row_id", "category"], "left").select(
            "row_id", "category", (F.col("logprior") + F.coalesce("v", F.lit(0.0))).alias("jll")
        )

    def probabilities(self, features: DataFrame, rows: DataFrame) -> DataFrame:
        """``(row_id, category, p)``, normalised per row."""
        w = Window.partitionBy("row_id")
        shifted = self.scores(features, rows).withColumn("e", F.exp(F.col("jll") - F.max("jll").over(w)))
        return shifted.select("row_id", "category", (F.col("e") / F.sum("e").over(w)).alias("p"))

    def predict(self, features: DataFrame, rows: DataFrame) -> DataFrame:
        """``(row_id, prediction)``; equal scores go to the first class by name."""
        best = F.min(F.struct((-F.round("jll", 9)).alias("s"), F.col("category")))
        return self.scores(features, rows).groupBy("row_id").agg(best["category"].alias("prediction"))


def fit_naive_bayes(features: DataFrame, labels: DataFrame, vocabulary: DataFrame, alpha: float = NB_ALPHA) -> NaiveBayesModel:
    """Fit on long features and ``labels(row_id, label)``; ``alpha`` smooths every vocabulary term.

    Features that carry their ``label`` (``transform(…, keep=["label"])``) need no join with the labels; sums of them by
    label (``class_sums``) do as well.
    """
    by_class = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    prior = materialise(by_class.select(F.col("label").alias("category"), F.ln(F.col("n") / total).alias("logprior")))
    labelled = features if "label" in features.columns else features.join(labels, "row_id")
    classes = [r["category"] for r in prior.where(F.col("category").isNotNull()).orderBy("category").collect()]
    sums = F.array(*[F.coalesce(F.sum(F.when(F.col("label") == c, F.col("weight"))), F.lit(0.0)) for c in classes]).cast("array<double>")
    by_term = labelled.groupBy("idx").agg(sums.alias("_m"))
    smoothed = F.array(*[F.coalesce(F.get("_m", F.lit(i)), F.lit(0.0)) + alpha for i in range(len(classes))])
    mass = store(vocabulary.select("idx").join(by_term, "idx", "left").select("idx", smoothed.cast("array<double>").alias("mass")))
    totals = mass.agg(F.lit(0.0), *[F.sum(F.col("mass")[i]) for i in range(len(classes))]).first()[1:]
    return NaiveBayesModel(mass, classes, [t or 0.0 for t in totals], prior)


class Classifier:
    """Fit and predict with one of the four classifier families on ML vectors.

    ``svc`` is ``linear.LinearSvm`` (``params``: ``c``, ``tol``, ``max_newton``) and has no probabilities, ``mlp`` is
    ``perceptron.Perceptron``; for the others ``params`` go to the Spark estimator.
    """

    def __init__(self, method: str = "logreg", **params) -> None:
        if method not in METHODS:
            raise ValueError(f"classifier {method!r} is none of {METHODS}")
        self.method = method
        self.params = params
        self._model = None
        self._classes: list[str] | None = None

    @property
    def classes(self) -> list[str]:
        if self._classes is None:
            raise RuntimeError("the classifier has not been fitted yet")
        return self._classes

    def _estimator(self, n_rows: int):
        common = {"featuresCol": "features", "labelCol": "_y"}
        inverse_c = 1.0 / max(n_rows, 1)
        if self.method == "nb":
            return NaiveBayes(**common, modelType="multinomial", smoothing=NB_ALPHA, **self.params)
        if self.method == "logreg":
            # one weight vector for two classes, one per class beyond; the penalty is per class either way
            settings = {"regParam": inverse_c, "maxIter": 100, "standardization": False, **self.params}
            return LogisticRegression(**common, family="auto", elasticNetParam=0.0, **settings)
        raise ValueError(f"{self.method!r} is fitted without an estimator")

    def fit(self, df: DataFrame, label: str = "label") -> "Classifier":
        train = df.select(F.col(label).alias("_label"), "features")
        indexer = StringIndexer(inputCol="_label", outputCol="_y", stringOrderType="alphabetAsc").fit(train)
        classes = list(indexer.labels)
        info = train.agg(F.count(F.lit(1)).alias("n")).first()
        width = train.first()["features"].size
        if len(classes) < 2:
            raise ValueError("a classifier needs two classes")
        if self.method != "mlp" and len(classes) * (width + 1) > wide.WIDE and not set(self.params) - WIDE_PARAMS:
            self._model = self._fit_wide(indexer.transform(train), classes, width, info["n"])
            self._classes = classes
            return self
        if self.method in ("svc", "mlp"):
            rows = indexer.transform(train)
            fitted = fit_svm(pack(rows), classes, width, **self.params) if self.method == "svc" else None
            self._model = fitted or fit_perceptron(rows, classes, width, **{"seed": RANDOM_SEED, **self.params})
            self._classes = classes
            return self
        estimator = self._estimator(info["n"])
        # an iteration over few rows is all task overhead: small inputs use few tasks
        few = max(1, -(-info["n"] // MIN_ROWS_PER_TASK))
        self._model = estimator.fit(indexer.transform(train).coalesce(few))
        self._classes = classes
        return self

    def _fit_wide(self, rows: DataFrame, classes: list[str], width: int, n_rows: int) -> wide.WideModel:
        """The same minimum or counts, with coefficients as a table: beyond ``wide.WIDE`` of them."""
        given = self.params
        if self.method == "nb":
            return wide.fit_wide_bayes(rows, classes, width, given.get("smoothing", NB_ALPHA))
        if self.method == "svc":
            return wide.fit_wide(rows, classes, "svc", 1 / given.get("c", 1.0), given.get("tol", 1e-4), given.get("max_newton", 100))
        lam = given.get("regParam", 1.0 / max(n_rows, 1)) * n_rows
        return wide.fit_wide(rows, classes, "logreg", lam, given.get("tol", 1e-6), given.get("maxIter", 100))

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and ``proba`` (map from class to probability)."""
        if isinstance(self._model, wide.WideModel):
            return self._model.predict(df)
        names = F.array(*[F.lit(c) for c in self.classes])
        if self.method == "svc":
            return self._model.predict(df).withColumn("proba", F.lit(None).cast("map<string,double>"))
        if self.method == "mlp":
            return self._model.predict(df)
        scored = self._model.transform(df)
        label = F.get(names, F.col("prediction").cast("int"))
        proba = F.map_from_arrays(names, vector_to_array("probability"))
        return scored.withColumn("_label", label).withColumn("proba", proba).drop(
            "prediction", "rawPrediction", "probability"
        ).withColumnRenamed("_label", "prediction")

    def predict_proba(self, df: DataFrame, key: str = "row_id") -> DataFrame | None:
        """``(key, category, p)`` or ``None`` when the family has no probabilities."""
        if self.method == "svc":
            self.classes  # raises before the first fit
            return None
        return self.predict(df).select(key, F.explode("proba").alias("category", "p"))
