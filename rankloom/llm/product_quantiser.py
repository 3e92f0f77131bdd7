"""Embedding near-duplicates by product quantisation with an inverted file.

Equal vectors form a class with a multiplicity; classes are indexed, those of each width apart. Coarse
centroids cut the space into inverted lists; the residual to the centroid is coded by one byte per
subspace. A query probes every list whose cell it nearly touches: the distance to the bisecting plane between the
nearest centroid and the list's is at most a margin. In a probed list the asymmetric distance (table look-ups
of the query's products with the codewords) and the stored length of what the code leaves out bound
the cosine from above; pairs that may reach the threshold are compared exactly, in double precision.

Two linked unit vectors are at most ``sqrt(2 - 2 * threshold)`` apart. The nearer of them to a plane between them is
at most half of that away (``reach=None`` probes so far and loses no link); along the normal of one given
plane a difference in any direction has ``1 / sqrt(width)`` of its length as its standard deviation, and the default
margin is ``reach`` = 3 of these. Recall against brute force is measured in the README.

There are ``2 sqrt(n)`` lists for n classes. Centroids and codewords are fitted on at most ``sample`` classes, or eight
for each list if that is more, in hash order; centroids in two levels, so that the fit stays cheap. Every
class is indexed and is a query. A pair is found if either vector probes the other's list, and counts once
for both ends. Lists are searched in blocks of members by blocks of queries, so a list with a third of all
vectors is spread over many tasks; blocks return sums and the edges of a spanning forest, not pairs.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing and stand for
themselves; vectors of different widths never link. Lengths from the least to the largest doubles are told apart
(vectors are scaled by their largest component first). Repeated ids keep their rows; null ids never name a
component unless all are null. An empty table gives an empty table. Labels and extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.kernels import give_back, mix
from rankloom.llm.tables import bounded_batches, components, join_by, stored

SAMPLE = 20_000
REACH = 3.0
SUBSPACES = 8
CODEWORDS = 256
BLOCK = 1024


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, width, class, vector``: the last three null where a vector is unusable."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column("embedding")
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        usable, keys, raw = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.uint64), [None] * n
        for width in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero(sizes == width)
            x = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width) + 0.0  # one form of zero
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            at, x = at[good], np.ascontiguousarray(x[good])
            bits, key = x.view(np.uint64), np.full(len(x), width, dtype=np.uint64)
            for i in range(width):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, i] + np.uint64(1))
            usable[at], keys[at] = True, key
            for i, row in zip(at, x):
                raw[i] = row.tobytes()
        columns = [batch.column("vec_id"), pa.array(sizes, pa.int32(), mask=~usable), pa.array(keys.view(np.int64), mask=~usable), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "width", "class", "vector"])
    give_back()


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _nearest(x, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
        empty = np.flatnonzero(~filled)
        if len(empty):
            centres[empty] = x[rng.choice(len(x), size=len(empty))]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Quantiser:
    """Coarse centroids, and per subspace the codewords of the residuals."""

    centroids: np.ndarray
    codewords: np.ndarray  # subspace, word, component
    bounds: np.ndarray  # components of each subspace

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, code and length of what the code leaves out, for unit vectors."""
        lists = _nearest(x, self.centroids)
        rest = x - self.centroids[lists]
        codes = np.zeros((len(x), len(self.codewords)), dtype=np.uint8)
        left = rest.copy()
        for s, words in enumerate(self.codewords):
            lo, hi = self.bounds[s], self.bounds[s + 1]
            codes[:, s] = _nearest(rest[:, lo:hi], words[:, : hi - lo])
            left[:, lo:hi] -= words[codes[:, s], : hi - lo]
        return lists, codes, np.linalg.norm(left, axis=1)

    def probes(self, x: np.ndarray, lists: np.ndarray, margin: float) -> list[np.ndarray]:
        """Lists whose cell comes within ``margin`` of each vector, its own among them."""
        half = (self.centroids**2).sum(axis=1) / 2
        out = []
        step = max(1, (1 << 21) // len(self.centroids))
        for i in range(0, len(x), step):
            near = x[i : i + step] @ self.centroids.T - half
            own = lists[i : i + step]
            gap = near[np.arange(len(own)), own][:, None] - near
            between = 2 * (half[own][:, None] + half[None, :] - self.centroids[own] @ self.centroids.T)
            out += [np.flatnonzero(row) for row in gap <= margin * np.sqrt(np.maximum(between, 0)) + 1e-12]
        return out


def _centroids(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """About ``k`` centroids: a coarse split, each part cut into its share."""
    parts = int(k**0.5)
    if k < 256:
        return _k_means(x, k, rng)
    top = _k_means(x, parts, rng)
    own = _nearest(x, top)
    found = [_k_means(x[own == i], max(1, round(k * (own == i).mean())), rng) for i in range(len(top)) if (own == i).any()]
    return np.concatenate(found)


def fit(x: np.ndarray, lists: int, *, subspaces: int = SUBSPACES, seed: int = 7) -> Quantiser:
    """Fit on unit vectors ``x`` (the bounded sample)."""
    rng = np.random.default_rng(seed)
    centroids = _centroids(x, lists, rng)
    rest = x - centroids[_nearest(x, centroids)]
    width = x.shape[1]
    bounds = np.linspace(0, width, min(subspaces, width) + 1).astype(int)
    words = np.zeros((len(bounds) - 1, min(CODEWORDS, len(x)), int(np.diff(bounds).max())))
    for s in range(len(bounds) - 1):
        words[s, :, : bounds[s + 1] - bounds[s]] = _k_means(rest[:, bounds[s] : bounds[s + 1]], CODEWORDS, rng, rounds=6)
    return Quantiser(centroids, words, bounds)


def _units(raw: list[bytes], width: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _index(quantiser: Quantiser, width: int, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x = _units(part.column("vector").to_pylist(), width)
                lists, codes, left = quantiser.encode(x)
                probes = quantiser.probes(x, lists, margin)
                columns = [*part.columns, pa.array(lists.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left), pa.array([p.astype(np.int32) for p in probes], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "list", "code", "left", "probes"])

    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component in the graph of edges a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _search(quantiser: Quantiser, width: int, threshold: float):
    """Links inside one block: summed multiplicities per class, and edges that connect what is linked."""

    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        member, query = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        empty = {"class": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())}
        if not len(member) or not len(query):
            return pa.table(empty)
        cls, times, lists = (table.column(k).to_numpy() for k in ("class", "times", "list"))
        x = _units(table.column("vector").to_pylist(), width)
        home = int(lists[member[0]])
        codes = np.frombuffer(b"".join(table.column("code").take(pa.array(member)).to_pylist()), np.uint8).reshape(len(member), -1)
        left = table.column("left").to_numpy()[member]
        # asymmetric look-ups: the query's product with each codeword, then a sum over the member's code
        reach = np.add.outer((x[query] @ quantiser.centroids[home]).astype(np.float32), left.astype(np.float32))
        for s, words in enumerate(quantiser.codewords):
            lo, hi = quantiser.bounds[s], quantiser.bounds[s + 1]
            reach += np.take((x[query, lo:hi] @ words[:, : hi - lo].T).astype(np.float32), codes[:, s], axis=1)
        i, j = np.nonzero(reach >= threshold - 1e-4)  # more than single precision can be off
        keep = []
        for lo in range(0, len(i), 1 << 17):
            a, b = query[i[lo : lo + (1 << 17)]], member[j[lo : lo + (1 << 17)]]
            keep.append(np.einsum("ij,ij->i", x[a], x[b]) >= threshold)
        ok = np.concatenate(keep) if keep else np.zeros(0, bool)
        a, b = query[i[ok]], member[j[ok]]
        differ = cls[a] != cls[b]
        a, b = a[differ], b[differ]
        if not len(a):
            return pa.table(empty)
        links = np.zeros(len(cls), dtype=np.int64)
        np.add.at(links, a, times[b])
        # a member that doesn't probe the query's list won't find the query itself
        probes = table.column("probes").combine_chunks().take(pa.array(member))
        counts = pc.list_value_length(probes).to_numpy(zero_copy_only=False)
        row = np.full(len(cls), -1)
        row[member] = np.arange(len(member))
        n_lists = len(quantiser.centroids)
        probed = np.sort(np.repeat(np.arange(len(member)), counts) * n_lists + probes.flatten().to_numpy(zero_copy_only=False))
        wanted = row[b] * n_lists + lists[a]
        back = probed[np.minimum(np.searchsorted(probed, wanted), len(probed) - 1)] != wanted
        np.add.at(links, b[back], times[a[back]])
        nodes, at = np.unique(np.concatenate([cls[a], cls[b]]), return_inverse=True)
        root = nodes[_forest(len(nodes), at[: len(a)], at[len(a) :])]
        total = np.zeros(len(nodes), dtype=np.int64)
        used = np.flatnonzero(links)
        np.add.at(total, np.searchsorted(nodes, cls[used]), links[used])
        return pa.table({"class": nodes, "links": total, "root": root})

    return run


def _margin(threshold: float, width: int, reach: float | None = None) -> float:
    """How far from a plane the nearer of two linked vectors is looked for: half their largest distance, or ``reach``
    standard deviations of its part along the plane's normal where that is less."""
    whole = max((1 - threshold) / 2, 0.0) ** 0.5
    return min(whole, whole * reach / width**0.5 if reach is not None else whole) + 1e-9


_FOUND = "class long, links long, root long"


def _links(classes: DataFrame, width: int, threshold: float, reach: float | None, sample: int, block: int) -> DataFrame:
    """``_FOUND`` rows of all pairs among the classes of one width."""
    n = classes.count()
    lists = max(1, int(2 * n**0.5))
    size = max(sample, 8 * lists)
    picked = classes.orderBy(F.xxhash64("class"), "class").select("vector").limit(size).collect()  # the bounded sample
    quantiser = fit(_units([r["vector"] for r in picked], width), lists)
    index = stored(
        classes.select("class", "times", "vector").repartition("class").mapInArrow(
            _index(quantiser, width, _margin(threshold, width, reach)), "class long, times long, vector binary, list int, code binary, left double, probes array<int>"
        ),
        "pq_index",
    )
    # blocks of each list: of members, and of the queries that probe it (one row per list)
    members = index.groupBy(F.col("list").alias("at")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("m"))
    queries = index.select(F.explode("probes").alias("at")).groupBy("at").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("q"))
    grid = F.broadcast(members.join(queries, "at"))  # 2 sqrt(n) rows
    spot = F.xxhash64("class", F.lit(1))
    held = (
        index.withColumn("at", F.col("list")).join(grid, "at").withColumn("mb", F.pmod(spot, F.col("m").cast("long")).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("q") - 1))).withColumn("role", F.lit(0))
    )
    asking = (
        index.withColumn("at", F.explode("probes")).join(grid, "at").withColumn("qb", F.pmod(spot, F.col("q").cast("long")).cast("int")).withColumn("mb", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).withColumn("role", F.lit(1))
    )
    # only members need their probes, only members their code
    asking = asking.withColumn("probes", F.lit(None).cast("array<int>")).withColumn("code", F.lit(None).cast("binary"))
    columns = ["at", "mb", "qb", "role", "class", "times", "vector", "list", "code", "left", "probes"]
    return held.select(*columns).unionByName(asking.select(*columns)).groupBy("at", "mb", "qb").applyInArrow(_search(quantiser, width, threshold), _FOUND)


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.9, reach: float | None = REACH, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (vec_id, embedding)."""
    rows = bounded_batches(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    read = stored(rows.mapInArrow(_read, "vec_id long, width int, class long, vector binary"), "pq_rows")
    classes = read.where("class IS NOT NULL").groupBy("class").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector"), F.first("width").alias("width"))
    classes = stored(classes, "pq_classes")
    # one row per width; a width with one class has no pair to look for
    widths = [r["width"] for r in classes.groupBy("width").count().where("count > 1").orderBy("width").collect()]
    found = classes.where("false").select("class", F.lit(0).cast("long").alias("links"), F.col("class").alias("root"))
    for width in widths:
        found = found.unionByName(_links(classes.where(F.col("width") == width), width, threshold, reach, sample, block))
    found = stored(found, "pq_links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    labels = components(found.where("class <> root").select(F.col("class").alias("src"), F.col("root").alias("dst")))
    named = join_by(classes.select("class", "first", "times"), labels.select(F.col("node").alias("class"), "component"), ["class"], "left")
    named = stored(join_by(named, links, ["class"], "left").withColumn("node", F.coalesce("component", "class")).drop("component"), "pq_named")
    smallest = named.groupBy("node").agg(F.min("first").alias("component_id"))
    named = stored(join_by(named, smallest, ["node"], "left").select("class", "times", "links", "component_id"), "pq_components")
    out = join_by(read.select("vec_id", "class"), named, ["class"], "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.when(F.col("class").isNull(), F.lit(0).cast("long")).otherwise(F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
