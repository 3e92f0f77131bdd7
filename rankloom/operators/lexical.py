"""Sparse retrieval on a postings table: TF-IDF cosine, BM25 Okapi, BM25+.

Data flow of one search (nothing is ever built per query on the driver):

* documents are tokenised and counted inside their own row (no shuffle), then cut
  to the terms the queries use;
* the surviving postings are stored, and only they are partitioned by ``doc_id``: a block of documents
  meets a block of queries in one task, which adds up one query after the other;
* a block keeps its own best ``k`` per query, so the far larger set of pairs never exists as rows.

A row with the empty term carries the length of every document, so collection
size and mean length come from the same postings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rankloom.functions.text import tokenizer
from rankloom.operators.common import fits_broadcast, free_ids, global_position, join_bounded, keep_best, materialise, store, top_k

# --- fixed values -----------------------------------------------------------
BM25_K1 = 1.5
BM25_B = 0.75
OKAPI_EPSILON = 0.25
PLUS_DELTA = 1.0
BM25_METHODS = ("plus", "okapi")
# ----------------------------------------------------------------------------

LENGTH_ROW = ""  # term of the row that carries the document length
HOT_TERMS = 100_000  # at most this many frequent terms are broadcast
LISTED_FILL = 1024  # rankings up to this length are filled from a list of ids
BLOCK_POSTINGS = 1 << 22  # of a block of documents
BLOCK_WEIGHTS = 1 << 21  # terms of a block of queries
MIN_BLOCK_POSTINGS = 50_000
ROWS_PER_BATCH = 1 << 16  # of counted terms


def count_terms(df: DataFrame, keys: list[str], tokens: Column, base: bool = False) -> DataFrame:
    """``(keys…, dl, term, tf)`` plus one length row per input row, no shuffle.

    The tokens of a batch of rows are numbered and counted together; ``dl`` is the number of
    tokens. The length row has the empty term and ``tf = 1``. With ``base`` the length of the row's vector before idf,
    the root of the sum of ``(1 + ln tf)^2``, goes along.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    tokenised = df.select(*keys, tokens.alias("_t")).where(F.col("_t").isNotNull())
    counted = [("dl", T.IntegerType()), ("term", T.StringType()), ("tf", T.IntegerType()), *([("base", T.DoubleType())] if base else [])]
    fields = [*[tokenised.schema[c] for c in keys], *[T.StructField(n, t) for n, t in counted]]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    return tokenised.mapInArrow(_term_counter(keys, to_arrow_schema(schema), base), schema)


def _term_counter(keys: list[str], schema: pa.Schema, base: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column("_t"), batch.num_rows
            coded = lists.flatten().dictionary_encode()
            names, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            empty = names.index(LENGTH_ROW).as_py()
            if empty < 0:
                names, empty = pa.concat_arrays([names, pa.array([LENGTH_ROW], names.type)]), len(names)
            dl = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
            row = np.repeat(np.arange(n), dl)
            pair = np.concatenate([row * len(names) + code, np.arange(n) * len(names) + empty])
            pair, tf = np.unique(pair, return_counts=True)
            row, code = np.divmod(pair, len(names))
            lengths = np.sqrt(np.bincount(row, np.where(code == empty, 0.0, (1 + np.log(tf)) ** 2), n)) if base else None
            for lo in range(0, len(pair), ROWS_PER_BATCH):
                at = slice(lo, lo + ROWS_PER_BATCH)
                columns = [*[batch.column(c).take(pa.array(row[at])) for c in keys], pa.array(dl[row[at]]), names.take(pa.array(code[at])), pa.array(tf[at].astype(np.int32))]
                columns += [pa.array(lengths[row[at]])] if base else []
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return count


def query_terms(queries: DataFrame, tokenize, text_col: str = "content") -> DataFrame:
    """``(qid, term, qtf)``; repeated query words raise ``qtf``."""
    counted = count_terms(queries, ["qid"], tokenize(F.col(text_col)))
    return materialise(counted.where(F.col("term") != LENGTH_ROW).select("qid", "term", F.col("tf").alias("qtf")))


def term_stats(postings: DataFrame) -> DataFrame:
    """``(term, df, cf, dl_sum)``; the length row holds the collection totals."""
    return postings.groupBy("term").agg(
        F.count_if(F.col("tf") > 0).alias("df"),
        F.sum("tf").alias("cf"),
        F.sum("dl").alias("dl_sum"),
    )


def collection_stats(stats: DataFrame) -> Column:
    """One struct ``(n_docs, avgdl)`` as a scalar subquery."""
    row = stats.where(F.col("term") == LENGTH_ROW).agg(
        F.struct(
            F.sum("df").alias("n_docs"),
            (F.sum("dl_sum") / F.sum("df")).alias("avgdl"),
        ).alias("c")
    )
    return row.scalar()


@dataclass(frozen=True)
class LexicalIndex:
    """Postings of a corpus, either scanned on the fly or stored as a table."""

    docs: DataFrame
    tokenizer_name: str = "tech"
    text_col: str = "content"
    stored: DataFrame | None = field(default=None, repr=False)
    buckets: int = 0

    @property
    def tokenize(self):
        return tokenizer(self.tokenizer_name)

    def all_postings(self) -> DataFrame:
        if self.stored is not None:
            return self.stored.select("doc_id", "dl", "term", "tf")
        return count_terms(self.docs, ["doc_id"], self.tokenize(F.col(self.text_col)))

    def matches(self, terms: DataFrame, small: bool) -> DataFrame:
        """Postings of ``terms`` and all length rows; one narrow pass over the corpus."""
        spark = terms.sparkSession
        length_term = spark.range(1).select(F.lit(LENGTH_ROW).alias("term"))
        wanted = terms.select("term").distinct().unionByName(length_term)
        postings = self.all_postings()
        if self.buckets:
            # at most ``buckets`` numbers come back; the others' folders are never opened
            used = [r[0] for r in wanted.select(_bucket(self.buckets)).distinct().collect()]
            postings = self.stored.where(F.col("bucket").isin(used)).select("doc_id", "dl", "term", "tf")
        kept = join_bounded(postings, wanted, "term", "left_semi", small_fits=small, salt_by="doc_id")
        return store(kept.select("doc_id", "dl", "term", "tf"))


def tokenised_once(index: LexicalIndex) -> LexicalIndex:
    """The same index with its postings stored, for searches that also need statistics of all terms."""
    if index.stored is not None:
        return index
    return LexicalIndex(index.docs, index.tokenizer_name, index.text_col, store(index.all_postings()))


def fit_lexical(docs: DataFrame, text_col: str = "content", tokenizer_name: str = "tech") -> LexicalIndex:
    """Index over ``docs(doc_id, text_col)``; lazy, nothing is read yet."""
    tokenizer(tokenizer_name)
    return LexicalIndex(docs, tokenizer_name, text_col)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")


def write_index(index: LexicalIndex, path: str, buckets: int = 256, salts: int = 8) -> None:
    """Store all postings in one folder per term bucket, sorted by term inside each file.

    A hot term is spread over ``salts`` files of its bucket by document.
    """
    (
        index.all_postings()
        .withColumn("bucket", _bucket(buckets))
        .withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .repartition("bucket", "_salt")
        .drop("_salt")
        .sortWithinPartitions("bucket", "term", "doc_id")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(path)
    )


def open_index(
    spark: SparkSession,
    path: str,
    docs: DataFrame,
    tokenizer_name: str = "tech",
    text_col: str = "content",
    buckets: int = 256,
) -> LexicalIndex:
    """Index whose postings come from ``write_index``; ``docs`` only pads short results."""
    return LexicalIndex(docs, tokenizer_name, text_col, spark.read.parquet(path), buckets)


def fill_to_k(run: DataFrame, queries: DataFrame, docs: DataFrame, k: int, base: Column | None = None) -> DataFrame:
    """Exactly ``k`` rows per query: unmatched documents follow, smallest ids first.

    The ``k`` smallest ids always suffice, because a query short of ``k`` has all
    its matches in ``run``. No query meets the corpus. Rankings of up to
    ``LISTED_FILL`` rows are filled from one short list of ids, longer ones by position.
    """
    if k > LISTED_FILL:
        return _fill_by_position(run, queries, docs, k, base)
    pool = (
        docs.select("doc_id").orderBy("doc_id").limit(k)
        .agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).scalar()
    )
    found = run.groupBy("qid").agg(
        F.sort_array(F.collect_list(F.struct("rank", "doc_id", "score"))).alias("hits")
    )
    none = F.array().cast(found.schema["hits"].dataType)
    base = F.lit(0.0) if base is None else base
    rows = (
        queries.select("qid", base.alias("_base"))
        .join(found, "qid", "left")
        .withColumn("hits", F.coalesce("hits", none))
        .withColumn("_n", F.size("hits"))
        .withColumn(
            "_fill", F.slice(F.array_except(pool, F.transform("hits", lambda h: h["doc_id"])), F.lit(1), k - F.col("_n"))
        )
    )
    enough = F.col("_n") + F.size("_fill") == k
    listed = rows.select(
        "qid",
        "_base",
        F.posexplode(
            F.when(
                enough,
                F.concat(
                    F.transform("hits", lambda h: F.struct(h["doc_id"].alias("doc_id"), h["score"].alias("score"))),
                    F.transform("_fill", lambda d: F.struct(d.alias("doc_id"), F.lit(0.0).alias("score"))),
                ),
            ).otherwise(F.raise_error(F.lit("the documents can't fill a ranking of the length asked for")))
        ).alias("_p", "_h"),
    )
    return listed.select(
        "qid",
        (F.col("_p") + 1).alias("rank"),
        "_h.doc_id",
        (F.col("_h.score") + F.col("_base")).alias("score"),
    )


def _fill_by_position(run: DataFrame, queries: DataFrame, docs: DataFrame, k: int, base: Column | None) -> DataFrame:
    """``fill_to_k`` for any ``k``: the missing ids are found by their place among the free ones."""
    run = materialise(run.select("qid", "rank", "doc_id", "score"))
    n_docs = docs.count()
    if n_docs < k and not queries.isEmpty():
        raise ValueError("the documents can't fill a ranking of the length asked for")
    places = global_position(docs.select("doc_id"), "doc_id", "pos").where(F.col("pos") < k)
    wanted = queries.select("qid", (F.lit(0.0) if base is None else base).alias("_base"))
    wanted = materialise(wanted.join(run.groupBy("qid").agg(F.count(F.lit(1)).alias("_n")), "qid", "left").withColumn("_n", F.coalesce("_n", F.lit(0))))
    free = free_ids(places, min(k, n_docs), run, wanted.select("qid", (k - F.col("_n")).alias("need")))
    filled = free.select("qid", "doc_id", F.lit(0.0).alias("score"), "free").unionByName(
        run.select("qid", "doc_id", "score", (F.col("rank") - 1).cast("long").alias("free")).withColumn("_hit", F.lit(True)), allowMissingColumns=True
    )
    rank = F.when(F.col("_hit"), F.col("free") + 1).otherwise(F.col("_n") + F.col("free") + 1).cast("int")
    return filled.join(wanted, "qid").select("qid", rank.alias("rank"), "doc_id", (F.col("score") + F.col("_base")).alias("score"))


def _okapi_floor(stats: DataFrame, n_docs: Column) -> Column:
    """Epsilon times the mean idf of the whole vocabulary, negatives included."""
    raw = F.ln(n_docs - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    return stats.where(F.col("term") != LENGTH_ROW).agg((F.avg(raw) * OKAPI_EPSILON).alias("floor")).scalar()


def bm25_search(
    index: LexicalIndex, queries: DataFrame, k: int, method: str = "plus", text_col: str = "content"
) -> DataFrame:
    """Top ``k`` documents per query as ``(qid, rank, doc_id, score)``."""
    if k <= 0:
        raise ValueError(f"a ranking of {k} rows can't be made")
    if method not in BM25_METHODS:
        raise ValueError(f"BM25 form {method!r} is none of {BM25_METHODS}")
    if method == "okapi":
        index = tokenised_once(index)
    terms = query_terms(queries, index.tokenize, text_col)
    small = fits_broadcast(terms)
    matches = index.matches(terms, small)
    stats = materialise(term_stats(matches))
    totals = collection_stats(stats)
    n_docs, avgdl = totals["n_docs"], totals["avgdl"]
    if method == "plus":
        idf = F.ln((n_docs + 1) / F.col("df"))
    else:
        raw = F.ln(n_docs - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
        vocabulary = materialise(term_stats(index.all_postings()))
        floor = vocabulary.agg(F.first(_okapi_floor(vocabulary, n_docs)).alias("f")).first()["f"] or 0.0
        idf = F.when(raw < 0, F.lit(floor)).otherwise(raw)
    weighted = (
        terms.join(stats.where(F.col("term") != LENGTH_ROW), "term")
        .select("qid", "term", (F.col("qtf") * idf).alias("w"))
    )
    tf_part = F.col("tf") * (BM25_K1 + 1) / (
        F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / avgdl)
    )
    if method == "okapi" and floor < 0:
        return _okapi_below_zero(_score_pairs(matches, weighted, small, F.col("w") * tf_part), queries, index.docs, k)
    best = top_k(_best_pairs(matches, weighted, tf_part, stats, terms.count(), k), k)
    if method == "okapi":
        return fill_to_k(best, queries, index.docs, k)
    base = weighted.groupBy("qid").agg((F.sum("w") * PLUS_DELTA).alias("base"))
    with_base = queries.select("qid").join(base, "qid", "left").withColumn("base", F.coalesce("base", F.lit(0.0)))
    return fill_to_k(best, with_base, index.docs, k, F.col("base"))


def _okapi_below_zero(scored: DataFrame, queries: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Exact order when the mean idf is negative and matches can rank behind non-matches.

    Non-matches score 0 in id order, so the first ``k`` free ids of a query (or all it has) are ranked
    together with its matches. Only a vocabulary whose terms mostly sit in more than half of the
    documents gets here.
    """
    scored = materialise(scored)
    n_docs = docs.count()
    matched = queries.select("qid").join(scored.groupBy("qid").agg(F.count(F.lit(1)).alias("m")), "qid", "left")
    need = materialise(matched.select("qid", F.least(F.lit(k), n_docs - F.coalesce("m", F.lit(0))).alias("need")))
    places = global_position(docs.select("doc_id"), "doc_id", "pos")
    zeros = free_ids(places, n_docs, scored, need).select("qid", "doc_id", F.lit(0.0).alias("score"))
    candidates = top_k(scored, k).select("qid", "doc_id", "score").unionByName(zeros)
    return fill_to_k(top_k(candidates, k), queries, docs, k)


def _score_pairs(matches: DataFrame, weighted: DataFrame, small: bool, value: Column) -> DataFrame:
    """Sum ``value`` per (query, document); pairs are formed and summed inside the document's task."""
    parts = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_doc = matches.where(F.col("term") != LENGTH_ROW).repartition(parts, "doc_id")
    joined = join_bounded(by_doc, weighted, "term", small_fits=small, salt_by="doc_id")
    return joined.groupBy("qid", "doc_id").agg(F.sum(value).alias("score"))


def _best_pairs(matches: DataFrame, weighted: DataFrame, part: Column, stats: DataFrame, n_weights: int, k: int) -> DataFrame:
    """``(qid, doc_id, score)``: sums of ``w * part``, of each block of documents the best ``k`` per query.

    Blocks hold a bounded number of postings and of query terms; a cell of the grid is one group of a cogroup.
    """
    n_postings = stats.where(F.col("term") != LENGTH_ROW).agg(F.sum("df").alias("n")).first()["n"] or 0
    q_blocks, d_blocks = max(1, -(-n_weights // BLOCK_WEIGHTS)), max(1, -(-n_postings // BLOCK_POSTINGS))
    # small inputs still give every core a cell
    cores = matches.sparkSession.sparkContext.defaultParallelism
    d_blocks *= max(1, min(cores // (q_blocks * d_blocks), n_postings // MIN_BLOCK_POSTINGS))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = weighted.select("qid", "term", "w", block("qid", q_blocks).alias("_q"), each(d_blocks).alias("_d"))
    found = matches.where(F.col("term") != LENGTH_ROW).select("doc_id", "term", part.alias("part"), block("doc_id", d_blocks).alias("_d"), each(q_blocks).alias("_q"))
    schema = T.StructType([weighted.schema["qid"], matches.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return asked.groupBy("_q", "_d").cogroup(found.groupBy("_q", "_d")).applyInArrow(_pair_scorer(k, schema), schema)


def _sorted_codes(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Distinct values in ascending order, null first, and every row's place among them."""
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    order = pc.array_sort_indices(coded.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def _pair_scorer(k: int, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema)

    def score(asked: pa.Table, found: pa.Table) -> pa.Table:
        if not asked.num_rows or not found.num_rows:
            return arrow_schema.empty_table()
        terms, of_term = _sorted_codes(found.column("term"))
        doc_ids, doc = _sorted_codes(found.column("doc_id"))
        part = found.column("part").to_numpy()
        order = np.argsort(of_term.astype(np.int64) * len(doc_ids) + doc, kind="stable")
        of_term, doc, part = of_term[order], doc[order], part[order]
        first = np.append(True, (of_term[1:] != of_term[:-1]) | (doc[1:] != doc[:-1]))
        if not first.all():  # an id that repeats has a term more than once
            at = np.flatnonzero(first)
            of_term, doc, part = of_term[at], doc[at], np.add.reduceat(part, at)
        ends = np.searchsorted(of_term, np.arange(len(terms) + 1))
        known = asked.append_column("_t", pc.index_in(asked.column("term"), value_set=terms)).filter(pc.is_valid(pc.index_in(asked.column("term"), value_set=terms)))
        if not known.num_rows:
            return arrow_schema.empty_table()
        qids, query = _sorted_codes(known.column("qid"))
        term, weight = known.column("_t").to_numpy(), known.column("w").to_numpy()
        order = np.lexsort((weight, term, query))
        query, term, weight = query[order], term[order], weight[order]
        positive = bool((weight > 0).all() and (part > 0).all())  # then a sum of zero means no match
        borders = np.searchsorted(query, np.arange(len(qids) + 1)).tolist()
        from_, to, weight = ends[term].tolist(), ends[term + 1].tolist(), weight.tolist()
        q_at, d_at, scores = [], [], []
        for q in range(len(qids)):
            total, seen = np.zeros(len(doc_ids)), None if positive else np.zeros(len(doc_ids), bool)
            for i in range(borders[q], borders[q + 1]):
                rows = doc[from_[i] : to[i]]
                total[rows] += weight[i] * part[from_[i] : to[i]]
                if seen is not None:
                    seen[rows] = True
            hit = np.flatnonzero(total if seen is None else seen)
            keep = hit[keep_best(np.round(total[hit], 9), hit, k)]
            q_at.append(np.full(len(keep), q))
            d_at.append(keep)
            scores.append(total[keep])
        columns = [qids.take(pa.array(np.concatenate(q_at))), doc_ids.take(pa.array(np.concatenate(d_at))), pa.array(np.concatenate(scores))]
        return pa.table(columns, schema=arrow_schema)

    return score


@dataclass(frozen=True)
class TfidfModel:
    """Corpus postings with smoothed idf; document norms are derived on demand."""

    index: LexicalIndex
    sublinear_tf: bool = True

    def tf_weight(self) -> Column:
        return 1 + F.ln("tf") if self.sublinear_tf else F.col("tf").cast("double")


def fit_tfidf(docs: DataFrame, text_col: str = "content", sublinear_tf: bool = True) -> TfidfModel:
    return TfidfModel(fit_lexical(docs, text_col, "word"), sublinear_tf)


def smoothed_idf(n_docs: Column, df: Column) -> Column:
    return F.ln((1 + n_docs) / (1 + df)) + 1


def document_weights(model: TfidfModel) -> DataFrame:
    """Unnormalised ``(doc_id, term, w)`` over the full corpus.

    The dictionary is counted first. One that fits the broadcast limit joins in one
    narrow pass. A larger one is split: frequent terms (few, by Zipf most of the
    postings) are broadcast; a term is frequent when it holds more than 1/HOT_TERMS
    of all postings, so there are at most HOT_TERMS. The rest shuffles, and no key
    there is hot.
    """
    postings = model.index.all_postings()
    stats = materialise(term_stats(postings))
    totals = stats.agg(
        F.struct(
            F.sum(F.when(F.col("term") == LENGTH_ROW, F.col("df"))).alias("n_docs"),
            F.sum(F.when(F.col("term") != LENGTH_ROW, F.col("df"))).alias("n_postings"),
        ).alias("t")
    ).scalar()
    terms = stats.where(F.col("term") != LENGTH_ROW).select(
        "term",
        smoothed_idf(totals["n_docs"], F.col("df")).alias("idf"),
        (F.col("df") * HOT_TERMS > totals["n_postings"]).alias("_hot"),
    )
    real = postings.where(F.col("term") != LENGTH_ROW)
    idf = terms.select("term", "idf")
    if fits_broadcast(stats.select("term", "df")):
        pieces = real.join(F.broadcast(idf), "term")
    else:
        hot = F.broadcast(terms.where("_hot").select("term", "idf"))
        cold = terms.where(~F.col("_hot")).select("term", "idf")
        pieces = real.join(hot, "term").unionByName(real.join(cold, "term"))
    return pieces.select("doc_id", "term", (model.tf_weight() * F.col("idf")).alias("w"))


def document_norms(model: TfidfModel) -> DataFrame:
    return document_weights(model).groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def tfidf_search(model: TfidfModel, queries: DataFrame, k: int, text_col: str = "content") -> DataFrame:
    """Cosine top ``k`` with corpus idf on both sides; unknown query words drop out."""
    if k <= 0:
        raise ValueError(f"a ranking of {k} rows can't be made")
    index = tokenised_once(model.index)
    model = TfidfModel(index, model.sublinear_tf)
    terms = query_terms(queries, index.tokenize, text_col)
    small = fits_broadcast(terms)
    matches = index.matches(terms, small)
    stats = materialise(term_stats(matches))
    n_docs = collection_stats(stats)["n_docs"]
    idf = smoothed_idf(n_docs, F.col("df"))
    raw = terms.withColumnRenamed("qtf", "tf").join(stats.where(F.col("term") != LENGTH_ROW).select("term", "df"), "term")
    weighted = raw.select("qid", "term", (model.tf_weight() * idf).alias("qw"), idf.alias("idf"))
    q_norm = weighted.groupBy("qid").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("q_norm"))
    unit = weighted.join(q_norm, "qid").select("qid", "term", (F.col("qw") / F.col("q_norm") * F.col("idf")).alias("qw"))
    normed = join_bounded(matches, store(document_norms(model)), "doc_id")
    scored = _best_pairs(normed, unit.withColumnRenamed("qw", "w"), model.tf_weight() / F.col("norm"), stats, terms.count(), k)
    return fill_to_k(top_k(scored, k), queries, index.docs, k)
