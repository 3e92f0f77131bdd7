"""Weighted reciprocal-rank fusion, hybrid retrieval, pseudo-relevance feedback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankloom.operators.common import attach_docs, materialise, top_per_group
from rankloom.operators.dense import encode_texts, knn_search
from rankloom.operators.lexical import LexicalIndex, bm25_search, fit_lexical

# --- fixed values -----------------------------------------------------------
DEFAULT_RRF_K = 60
DEFAULT_WEIGHT_EMBEDDINGS = 3.5
DEFAULT_WEIGHT_BM25 = 0.5
# ----------------------------------------------------------------------------


def above_zero(**numbers: float) -> None:
    """Refuse the first setting that is not above zero, by its name."""
    for name, number in numbers.items():
        if not number > 0:
            raise ValueError(f"{name} is {number!r}, needs a number above zero")


def resolve_weights(defaults: Mapping[str, float], overrides: Mapping[str, float]) -> dict[str, float]:
    """Default source weights with per-config overrides; unknown names are an error."""
    unknown = sorted(set(overrides) - set(defaults))
    if unknown:
        raise ValueError(f"no such sources: {unknown}")
    resolved = {**defaults, **overrides}
    above_zero(**{f"weight of {name}": weight for name, weight in resolved.items()})
    return resolved


def stack_runs(runs: Mapping[str, DataFrame], key: str = "source") -> DataFrame:
    """Named runs as one long table."""
    stacked = None
    for name, run in runs.items():
        part = run.select(F.lit(name).alias(key), "qid", "rank", "doc_id", "score")
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def _config_rows(configs: Sequence[Mapping], sources: Sequence[str]) -> Column:
    """Literal array of ``(config, rrf_k, candidate_k, source, ord, w)``."""
    rows = []
    for cfg in configs:
        for order, source in enumerate(sources):
            rows.append(
                F.struct(
                    F.lit(cfg["name"]).alias("config"),
                    F.lit(int(cfg["rrf_k"])).alias("rrf_k"),
                    F.lit(int(cfg["candidate_k"])).alias("candidate_k"),
                    F.lit(source).alias("_source"),
                    F.lit(order).alias("ord"),
                    F.lit(float(cfg["weights"][source])).alias("w"),
                )
            )
    return F.array(*rows)


def fuse_configs(runs: DataFrame, configs: Sequence[Mapping], sources: Sequence[str], k_out: int | None = None) -> DataFrame:
    """Fuse ``runs(source, qid, rank, doc_id)`` under every config in one job.

    Each candidate row is repeated once per config (a literal list), then summed per
    (config, query, document). Equal scores keep the order of first appearance:
    source order, then rank.
    """
    for cfg in configs:
        depth = cfg["candidate_k"] if k_out is None else k_out
        above_zero(depth=depth, rrf_k=cfg["rrf_k"], **{f"weight of {s}": cfg["weights"][s] for s in sources})
    limit = k_out or max(int(c["candidate_k"]) for c in configs)
    matching = F.filter(
        _config_rows(configs, sources),
        lambda c: (c["_source"] == F.col("source")) & (F.col("rank") <= c["candidate_k"]),
    )
    rows = runs.select("source", "qid", "rank", "doc_id", F.explode(matching).alias("c"))
    fused = (
        rows.select("c.config", "c.candidate_k", "qid", "doc_id", "rank", "c.ord", (F.col("c.w") / (F.col("c.rrf_k") + F.col("rank"))).alias("part"))
        .groupBy("config", "candidate_k", "qid", "doc_id")
        .agg(F.sum("part").alias("score"), F.min(F.struct("ord", "rank")).alias("first_seen"))
        .withColumn("_key", F.round("score", 9))
    )
    order = [F.col("_key").desc(), F.col("first_seen").asc()]
    ranked = top_per_group(fused, ["config", "qid"], order, limit, spread_by=["doc_id"])
    return ranked.where(F.col("rank") <= F.col("candidate_k")).select("config", "qid", "rank", "doc_id", "score")


def fuse_named(
    runs: DataFrame, sources: Sequence[str], weights: Mapping[str, float], k_out: int, rrf_k: int = DEFAULT_RRF_K
) -> DataFrame:
    """Fusion of any number of named sources."""
    cfg = {"name": "fused", "rrf_k": rrf_k, "candidate_k": 2**31 - 1, "weights": dict(weights)}
    return fuse_configs(runs, [cfg], sources, k_out).drop("config")


def fuse_rankings_rrf(
    dense_run: DataFrame,
    bm25_run: DataFrame,
    k_out: int,
    rrf_k: int = DEFAULT_RRF_K,
    weight_embeddings: float = DEFAULT_WEIGHT_EMBEDDINGS,
    weight_bm25: float = DEFAULT_WEIGHT_BM25,
) -> DataFrame:
    """Two-source fusion; ties keep dense rank first, then BM25 rank."""
    runs = stack_runs({"embeddings": dense_run, "bm25": bm25_run})
    weights = {"embeddings": weight_embeddings, "bm25": weight_bm25}
    return fuse_named(runs, ["embeddings", "bm25"], weights, k_out, rrf_k)


def hybrid_search(
    docs: DataFrame,
    queries: DataFrame,
    top_k: int,
    *,
    n_docs: int | None = None,
    text_col: str = "content",
    index: LexicalIndex | None = None,
    bm25_method: str = "plus",
    candidate_multiplier: int = 1,
    rrf_k: int = DEFAULT_RRF_K,
    weight_embeddings: float = DEFAULT_WEIGHT_EMBEDDINGS,
    weight_bm25: float = DEFAULT_WEIGHT_BM25,
    doc_vectors: DataFrame | None = None,
    query_vectors: DataFrame | None = None,
    **encoder,
) -> DataFrame:
    """BM25 and dense candidates fused into one ranking of ``top_k``.

    Each side gives ``candidate_multiplier`` times ``top_k`` rows, or all documents if there are
    fewer. Vectors that are not given are encoded once and stored, since the search reads them
    several times.
    """
    above_zero(top_k=top_k, candidate_multiplier=candidate_multiplier)
    available = docs.count() if n_docs is None else n_docs
    if available < top_k:
        raise ValueError(f"{available} documents can't fill a ranking of {top_k}")

    def vectors(texts: DataFrame, key: str, given: DataFrame | None) -> DataFrame:
        return given if given is not None else materialise(encode_texts(texts, text_col, **encoder).select(key, "embedding"))

    depth = min(max(candidate_multiplier, 1) * top_k, available)
    nearest = knn_search(vectors(docs, "doc_id", doc_vectors), vectors(queries, "qid", query_vectors), depth)
    matched = bm25_search(index or fit_lexical(docs, text_col), queries, depth, bm25_method, text_col)
    return fuse_rankings_rrf(nearest, matched, top_k, rrf_k, weight_embeddings, weight_bm25)


def expand_queries(queries: DataFrame, expansions: Mapping[str, str], category_col: str = "prediction") -> DataFrame:
    """Append the category's vocabulary, or the category name where none is listed."""
    terms = F.create_map(*[F.lit(x) for pair in expansions.items() for x in pair])
    extra = F.coalesce(F.try_element_at(terms, F.col(category_col)), F.col(category_col))
    return queries.withColumn("content", F.concat(F.col("content"), F.lit(" "), extra))


def feedback_tags(run: DataFrame, docs: DataFrame, max_tags: int = 10) -> DataFrame:
    """Distinct tags of each query's ranked documents, in rank then tag order."""
    tags = (
        attach_docs(run, docs, ["tags"])
        .select("qid", "rank", F.posexplode("tags").alias("pos", "tag"))
        .where(F.trim("tag") != "")
        .groupBy("qid", "tag")
        .agg(F.min(F.struct("rank", "pos")).alias("seen"))
    )
    order = Window.partitionBy("qid").orderBy("seen")
    kept = tags.withColumn("n", F.row_number().over(order)).where(F.col("n") <= max_tags)
    return kept.groupBy("qid").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "tag"))), lambda x: x["tag"]).alias("tags"))


def pseudo_relevance_feedback(
    index: LexicalIndex, docs: DataFrame, queries: DataFrame, prf_top_k: int = 3, prf_max_tags: int = 10
) -> DataFrame:
    """Append the tags of the best BM25 documents to every query."""
    run = bm25_search(index, queries, prf_top_k)
    tags = feedback_tags(run, docs, prf_max_tags)
    return (
        queries.join(tags, "qid", "left")
        .withColumn("content", F.concat_ws(" ", "content", F.array_join("tags", " ")))
        .drop("tags")
    )
