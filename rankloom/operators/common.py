"""Joins with a checked broadcast, top-k per group, exact distributed ranks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rankloom.session import scratch_path, shared_dir

MAX_BROADCAST_BYTES = 128 * 1024 * 1024
DEFAULT_SALTS = 16
LEVELS, LEVEL_OFFSET = 64, 50_000  # steps per factor of e; more than the logarithm of any double takes


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder; partitioning is kept, lineage is cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Compute once into Parquet files in the shared folder.

    For tables as large as the input or larger: a checkpoint keeps whole rows uncompressed, columns of repeated words and
    ids take a small part of that. Partitioning is not kept. What was shuffled on the way is of no more use then: Spark
    removes such files when the driver collects its garbage, which a driver with memory to spare does too late for the disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def read_parallel(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a table stored in fewer splits than there are cores is spread out.

    On a large table the split count exceeds the core count and the scan is left alone.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _row_bytes(df: DataFrame) -> Column:
    """Upper estimate of one row's size in bytes."""
    total = F.lit(16)
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 32
        else:
            size = F.lit(8)
        total = total + size
    return total


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure ``df`` (one aggregate, one row back) against the broadcast limit."""
    used = df.agg(F.sum(_row_bytes(df)).alias("b")).first()["b"]
    return (used or 0) <= max_bytes


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str],
    how: str = "inner",
    *,
    small_fits: bool | None = None,
    salt_by: str | list[str] | None = None,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Join whose small side is broadcast only when its measured size allows it.

    Beyond the limit the join shuffles; ``salt_by`` names columns of ``big`` that
    spread one hot key over ``salts`` tasks, ``small`` being repeated per salt.
    Only inner, left and semi joins keep their meaning under that repetition.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported join type {how!r}")
    if small_fits is None:
        small_fits = fits_broadcast(small)
    if small_fits:
        return big.join(F.broadcast(small), keys, how)
    if salt_by is None:
        return big.join(small, keys, how)
    salt_cols = [salt_by] if isinstance(salt_by, str) else list(salt_by)
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_cols), F.lit(salts)).cast("int"))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_small, [*keys, "_salt"], how).drop("_salt")


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    *,
    spread_by: Sequence[str],
    rank_col: str = "rank",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """First ``k`` rows of every group under a total order, with their 1-based rank.

    Two levels: each (group, salt) keeps its own first ``k``, then the group picks
    from at most ``salts * k`` rows. A group holding a third of the table is thus
    sorted by ``salts`` tasks and the last task never sees more than that bound.
    """
    if k <= 0:
        raise ValueError(f"a ranking of {k} rows can't be made")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    inner = Window.partitionBy(*group, "_salt").orderBy(*order)
    outer = Window.partitionBy(*group).orderBy(*order)
    return (
        salted.withColumn("_r", F.row_number().over(inner))
        .where(F.col("_r") <= k)
        .drop("_r", "_salt")
        .withColumn(rank_col, F.row_number().over(outer))
        .where(F.col(rank_col) <= k)
    )


def _level(score: Column) -> Column:
    """A whole number that never falls where ``score`` grows: 64 steps per factor of e, null lowest, NaN highest."""
    steps = lambda x: F.floor(F.ln(x) * LEVELS).cast("int") + LEVEL_OFFSET
    finite = F.when(score > 0, steps(score)).when(score < 0, -steps(-score)).otherwise(0)
    top = 2 * LEVEL_OFFSET
    return F.when(score.isNull(), -top).when(F.isnan(score) | (score == float("inf")), top).when(score == float("-inf"), 1 - top).otherwise(finite)


def above_kth(df: DataFrame, group: Sequence[str], score: str, k: int) -> DataFrame:
    """Rows of the stored ``df`` that can be among the first ``k`` of their group by ``score`` descending.

    Scores are counted by level, a partial aggregate that merges wherever a group's rows lie; the level at which
    ``k`` rows are passed bounds the k-th score from below. Rows under it are dropped where they are,
    so what a ranking then shuffles doesn't hold the rest of a group, whatever ``k`` is.
    """
    levelled = df.withColumn("_level", _level(F.col(score)))
    counted = levelled.groupBy(*group, "_level").agg(F.count(F.lit(1)).alias("_n"))
    better = Window.partitionBy(*group).orderBy(F.col("_level").desc()).rowsBetween(Window.unboundedPreceding, -1)
    reached = counted.withColumn("_before", F.coalesce(F.sum("_n").over(better), F.lit(0))).where(F.col("_before") < k)
    bounds = reached.groupBy(*group).agg(F.min("_level").alias("_bound"))
    bounds = materialise(bounds.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_bound"))
    same = F.col("_level") >= F.col("_bound")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    side = F.broadcast(bounds) if fits_broadcast(bounds) else bounds
    return levelled.join(side, same).drop("_level", "_bound", *[f"_g_{g}" for g in group])


def top_k(scored: DataFrame, k: int, *, group: Sequence[str] = ("qid",), digits: int = 9) -> DataFrame:
    """Rank ``(qid, doc_id, score)`` rows: rounded score descending, then doc_id.

    Spark cuts a ranking before its exchange up to a length it is configured for; beyond that
    length ``above_kth`` does.
    """
    order = [F.col("_key").desc(), F.col("doc_id").asc()]
    keyed = scored.withColumn("_key", F.round("score", digits))
    if k > int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        keyed = above_kth(materialise(keyed), group, "_key", k)
    return top_per_group(keyed, list(group), order, k, spread_by=["doc_id"]).drop("_key")


def keep_best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best under (score desc, id asc)."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        pos = np.nonzero(scores >= kth)[0]
    else:
        pos = np.arange(len(scores))
    return pos[np.lexsort((ids[pos], -scores[pos]))][:k]


def hash_rank(df: DataFrame, group: str, id_col: str, seed: int, rank_col: str = "rn") -> DataFrame:
    """Exact 1-based rank inside ``group`` by ``md5(seed:id)``, without one task per group.

    The hash prefix cuts each group into small buckets. Bucket sizes (at most
    65,536 per group, one partial aggregate) give every bucket its offset, and the
    window only orders rows inside one bucket.
    """
    hashed = df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))))
    hashed = hashed.withColumn("_bucket", F.substring("_h", 1, 4))
    sizes = hashed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(
        group,
        "_bucket",
        (F.sum("_n").over(running) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(group)).alias("group_size"),
    )
    inside = Window.partitionBy(group, "_bucket").orderBy("_h", id_col)
    return (
        hashed.withColumn("_r", F.row_number().over(inside))
        .join(offsets, [group, "_bucket"])
        .withColumn(rank_col, F.col("_offset") + F.col("_r"))
        .drop("_h", "_bucket", "_offset", "_r")
    )


def global_position(df: DataFrame, key: str, out: str, rows_per_part: int = 200_000) -> DataFrame:
    """Stored rows of ``df`` with ``out``: the 0-based position in the order of the unique column ``key``.

    Ranges of the key are sorted apart; the rows before a range are a prefix sum over as many
    counts as there are ranges.
    """
    parts = max(1, -(-df.count() // rows_per_part))
    ranged = store(df.repartitionByRange(parts, key).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counted.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(key)) - 1
    placed = ranged.withColumn("_r", inside).join(F.broadcast(offsets), "_p")
    return store(placed.withColumn(out, F.col("_before") + F.col("_r")).drop("_p", "_r", "_before"))


def bucket_rank(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Exact 1-based rank of every row inside ``group`` by ``bucket`` (nulls last), then ``order``.

    Rows are only sorted inside one value of ``bucket``; the number of rows before it comes from
    the counted values, so a group of any length is spread over as many tasks as it has values.
    """
    keys = [*group, bucket]
    before = Window.partitionBy(*group).orderBy(F.col(bucket).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counted.select(*[F.col(c).alias(f"_o_{c}") for c in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_r", F.row_number().over(inside)).join(offsets, same)
    return ranked.withColumn(rank_col, (F.col("_before") + F.col("_r")).cast("int")).drop("_r", "_before", *[f"_o_{c}" for c in keys])


FREE_BUCKET = 1 << 16
FREE_STEP = 4096


def free_ids(positions: DataFrame, n: int, taken: DataFrame, need: DataFrame) -> DataFrame:
    """``(qid, doc_id, free)``: per query the first ``need`` ids that are not taken, ``free`` counting from 0.

    ``positions(doc_id, pos)`` numbers ``n`` ids, ``taken(qid, doc_id)`` are distinct, ``need(qid, need)`` must not
    exceed the ids left. Taken ids are counted per bucket of positions, which tells how many free ones lie before
    each bucket; inside the buckets that matter, gaps between taken positions are unrolled in
    steps. No list of ids is built, neither per query nor for all.
    """
    placed = materialise(taken.select("qid", "doc_id").join(positions, "doc_id").select("qid", "pos", F.expr(f"pos div {FREE_BUCKET}").alias("b")))
    counted = placed.groupBy("qid", "b").agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy("qid").agg(F.sum("_n").alias("_all"))
    wanted = need.where("need > 0").join(totals, "qid", "left").withColumn("_all", F.coalesce("_all", F.lit(0)))
    last = F.least(F.lit((n - 1) // FREE_BUCKET), F.expr(f"(need + _all) div {FREE_BUCKET}"))
    grid = wanted.select("qid", "need", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("b"))
    before = Window.partitionBy("qid").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    started = grid.join(counted, ["qid", "b"], "left").withColumn("_gone", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    started = started.withColumn("_free", F.col("b") * FREE_BUCKET - F.col("_gone")).where("_free < need").select("qid", "need", "b", "_free")
    # gaps: from each taken position (or the bucket's start) to the next one (or its end)
    edges = started.select("qid", "b", (F.col("b") * FREE_BUCKET - 1).alias("pos"))
    inside = join_bounded(placed, started.select("qid", "b"), ["qid", "b"], "left_semi").select("qid", "b", "pos")
    order = Window.partitionBy("qid", "b").orderBy("pos")
    end = F.least(F.lit(n), (F.col("b") + 1) * FREE_BUCKET)
    gaps = edges.unionByName(inside).select("qid", "b", "pos", F.coalesce(F.lead("pos").over(order), end).alias("_to"), (F.row_number().over(order) - 1).alias("_i"))
    gaps = gaps.join(started, ["qid", "b"])
    # the bucket's start stands for no taken id, so _i taken ones lie before the gap
    at = F.col("_free") + F.col("pos") + 1 - F.col("b") * FREE_BUCKET - F.col("_i")
    length = F.least(F.col("_to") - F.col("pos") - 1, F.col("need") - F.col("_at"))
    runs = gaps.withColumn("_at", at).withColumn("_len", length).where("_len > 0")
    steps = runs.select("qid", "pos", "_at", "_len", F.explode(F.expr(f"sequence(0L, _len - 1, {FREE_STEP}L)")).alias("_s"))
    rows = steps.select("qid", "pos", "_at", F.explode(F.expr(f"sequence(_s, least(_s + {FREE_STEP}, _len) - 1)")).alias("_o"))
    found = rows.select("qid", (F.col("pos") + 1 + F.col("_o")).alias("pos"), (F.col("_at") + F.col("_o")).alias("free"))
    return join_bounded(found, positions, "pos", salt_by="qid").select("qid", "doc_id", "free")


HEAVY_KEYS = 10_000


def join_heavy(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join of stored ``rows`` with a ``table`` that is unique in ``key``, whose keys may be hot in ``rows``.

    Keys are counted first. One that holds more than ``1 / HEAVY_KEYS`` of the rows is heavy; there are at most
    ``HEAVY_KEYS``, so their table rows are broadcast and their many rows stay where they are. Only the
    others are shuffled, and no key there is hot.
    """
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1)).alias("_t")).scalar()
    heavy = materialise(counted.where(F.col("_n") * HEAVY_KEYS > total).select(key))
    few = materialise(table.join(F.broadcast(heavy), key, "left_semi"))
    if heavy.isEmpty() or not fits_broadcast(few):
        return rows.join(table, key)  # adaptive execution splits what is skewed
    light = rows.join(F.broadcast(heavy), key, "left_anti").join(table, key)
    return rows.join(F.broadcast(few), key).unionByName(light)


def attach_docs(run: DataFrame, docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Run rows with document columns.

    A run that can be broadcast is the small side and the corpus stays in place; a larger one is joined by
    ``join_heavy``, as one document may be in every list.
    """
    run = materialise(run)
    chosen = docs.select("doc_id", *columns)
    if fits_broadcast(run):
        return chosen.join(F.broadcast(run), "doc_id")
    return join_heavy(run, chosen, "doc_id").select(*chosen.columns, *[c for c in run.columns if c != "doc_id"])
