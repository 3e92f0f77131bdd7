"""N-gram Jaccard join: rare-first prefix filtering, each surviving pair verified once.

A document's set holds the distinct hashes (64 bits) of its word n-grams; with fewer words than
``n`` the whole sequence is the one element. Texts with equal sets form a class and only classes
are joined, so exact copies never meet each other.

* Order: elements by corpus frequency, rare first. The frequency is that of the element's bucket in
  a table of fixed size counted over all documents. Any total order gives the same result; the
  table only decides how well common n-grams are kept out of the prefixes.
* Prefix, length and positional filters: a class posts its first ``size - ceil(t size) + 1`` elements.
* Hubs first: in each posting list every class is paired with the one that holds the element
  earliest in its order (an unedited original has fewer rare elements than its edited copies).
  Verified pairs give components; a posting list whose classes are all in one component is done.
  What is left is compared inside the list, only across components, in blocks of bounded size
  spread over the cluster. A group of near copies therefore costs a star, not its square, and no
  link that changes a component is lost.
* Suffix filter: the sets' histograms over 64 hash classes bound their symmetric difference.
* Verification: each remaining pair once, on the complete sets.
* Number of links: a link never leaves its component, so all pairs of classes inside each component
  are compared on their complete sets, in block pairs of bounded size; each pair meets once and only
  sums per class are rows.

Null, empty and blank texts have an empty set and are linked with nothing. Rows with the same id and
set are one document; with several texts under one id the smallest id still stands for each. Null ids
belong to their component but never name it unless all are null. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.kernels import LOWER, NON_SPACE, blobs, gram_hashes, mix, span_hashes, text_slices, word_spans
from rankloom.llm.tables import components, doc_rows, join_by, stored

FREQUENCY_SLOTS = 1 << 20
_BLOCK_SLOTS = 1 << 16
_FLUSH_BYTES = 64 << 20
LIST_BLOCK = 2048
_CLASSES = 64
_SALT_ROWS = 4096
SET_BYTES = 8 << 20
_TILE = 256
_COLUMNS = 1 << 13
_POSTING = ["list", "element", "class", "size", "place"]


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and element of every distinct n-gram, ascending within each row."""
    lower = LOWER[data]
    starts, ends, row = word_spans(lower, offsets, NON_SPACE)
    words = span_hashes(lower, starts, ends)
    per_row = np.bincount(row, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(per_row)])
    rows, grams = [], []
    if len(words) >= n:
        whole = row[: len(words) - n + 1] == row[n - 1 :]
        rows.append(row[: len(words) - n + 1][whole])
        grams.append(gram_hashes(words, n)[whole])
    for k in range(1, n):
        short = np.flatnonzero(per_row == k)
        if len(short):
            rows.append(short)
            grams.append(gram_hashes(words, k)[first[short]])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    r, g = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((g, r))
    r, g = r[order], g[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
    return r[new], g[new]


def _classes(r: np.ndarray, g: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and class (a hash of the set) of each row."""
    sizes = np.bincount(r, minlength=n_rows)
    sums = np.zeros(n_rows, dtype=np.uint64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        at = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        sums[filled] = np.add.reduceat(mix(g), at)
    return sizes, mix(sums + sizes.astype(np.uint64)).view(np.int64)


def _frequency_rows(counts: np.ndarray) -> pa.RecordBatch:
    """The filled slots of each block of the table, as slot and count."""
    blocks, packed = [], []
    for b in range(0, len(counts), _BLOCK_SLOTS):
        part = counts[b : b + _BLOCK_SLOTS]
        at = np.flatnonzero(part)
        if len(at):
            blocks.append(b // _BLOCK_SLOTS)
            packed.append(at.astype("<u4").tobytes() + part[at].astype("<i8").tobytes())
    n = len(blocks)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([none, none, none, pa.nulls(n, pa.binary()), pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], _SURVEY)


_SURVEY = ["doc_id", "size", "class", "hist", "block", "counts"]


def _histograms(r: np.ndarray, g: np.ndarray, n_rows: int) -> pa.Array:
    """Elements per hash class, 255 at most: a saturated count still bounds differences from below."""
    hist = np.bincount(r * _CLASSES + (g >> np.uint64(58)).astype(np.int64), minlength=n_rows * _CLASSES)
    return blobs(np.minimum(hist, 255).astype(np.uint8).tobytes(), np.arange(n_rows + 1) * _CLASSES)


def _survey(n: int, slots: int):
    """A row for each document, and the bucket frequencies of what the task has read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, read = np.zeros(slots, dtype=np.int64), 0
        for part, data, offsets in text_slices(batches, "text"):
            r, g = _sets(data, offsets, n)
            sizes, cls = _classes(r, g, part.num_rows)
            fresh = np.zeros(part.num_rows, dtype=bool)
            fresh[np.unique(cls, return_index=True)[1]] = True
            counts += np.bincount((g[fresh[r]] & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
            read += len(data)
            if read >= _FLUSH_BYTES:
                yield _frequency_rows(counts)
                counts[:], read = 0, 0
            none = [pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(cls), _histograms(r, g, part.num_rows), *none], _SURVEY)
        yield _frequency_rows(counts)

    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            k = len(raw) // 12
            into = sums.setdefault(block, np.zeros(_BLOCK_SLOTS, dtype=np.int64))
            into[np.frombuffer(raw, "<u4", k)] += np.frombuffer(raw, "<i8", k, 4 * k)
    packed = []
    for total in sums.values():
        at = np.flatnonzero(total)
        packed.append(at.astype("<u4").tobytes() + total[at].astype("<i8").tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["block", "counts"])


def _frequencies(survey: DataFrame, slots: int) -> np.ndarray:
    """The whole table (fixed size): summed where it lies, then by block."""
    partial = survey.where("block IS NOT NULL").select("block", "counts").mapInArrow(_add_counts, "block int, counts binary")
    total = np.zeros(slots, dtype=np.int64)
    for row in partial.repartition("block").mapInArrow(_add_counts, "block int, counts binary").collect():
        k = len(row["counts"]) // 12
        total[row["block"] * _BLOCK_SLOTS + np.frombuffer(row["counts"], "<u4", k)] = np.frombuffer(row["counts"], "<i8", k, 4 * k)
    return np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)


def _postings(n: int, percent: int, frequency: np.ndarray):
    """Prefix elements of each class of a slice, with the size of its set and the element's place.

    ``list`` is the element, or the element with a salt where its bucket is far above the mean, so
    that no posting list of a very common element meets in one task.
    """
    usual = 2 * int(frequency.mean()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, "text"):
            r, g = _sets(data, offsets, n)
            sizes, cls = _classes(r, g, part.num_rows)
            fresh = np.zeros(part.num_rows, dtype=bool)
            fresh[np.unique(cls, return_index=True)[1]] = True
            keep = fresh[r]
            r, g = r[keep], g[keep]
            order = np.lexsort((g, frequency[(g & np.uint64(len(frequency) - 1)).astype(np.int64)], r))
            r, g = r[order], g[order]
            first = np.searchsorted(r, np.arange(part.num_rows))
            place = np.arange(len(r)) - first[r]
            prefix = place < (sizes - (percent * sizes + 99) // 100 + 1)[r]
            r, g, place = r[prefix], g[prefix], place[prefix]
            parts = 1 + np.maximum(frequency[(g & np.uint64(len(frequency) - 1)).astype(np.int64)].astype(np.int64) - usual, 0) // _SALT_ROWS
            salt = cls[r].view(np.uint64) % parts.astype(np.uint64)
            lists = np.where(parts > 1, mix(g + salt * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), g)
            columns = [lists.view(np.int64), g.view(np.int64), cls[r], sizes[r].astype(np.int32), place.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _POSTING)

    return run


def _lists(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows of one key (sorted input) are never split; single batches per run of keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            held.append(batch.slice(0, cut))
            yield _one(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    return table.to_batches()[0]


def _hub_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of lists with several classes (and of salted lists), each with its list's first row, the hub.

    Rows come by list, then place. A list is read as a stream: only its hub and its first row, which
    is held back until a second one shows that it isn't alone, are kept. Repeated rows are dropped.
    """
    hub = held = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in _POSTING]
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[2][1:] != columns[2][:-1])
        new[0] = last != (columns[0][0], columns[2][0])
        last = (columns[0][-1], columns[2][-1])
        columns = [x[new] for x in columns]
        if held is not None:
            columns = [np.concatenate([[h], x]).astype(x.dtype) for h, x in zip(held, columns)]
        lists = columns[0]
        if not len(lists):
            continue
        starts = np.ones(len(lists), dtype=bool)
        starts[1:] = lists[1:] != lists[:-1]
        goes_on = held is None and hub is not None and hub[0] == lists[0]
        starts[0] = not goes_on
        first, at = np.flatnonzero(starts), np.cumsum(starts) - 1
        hubs = [np.append(x[first], 0).astype(x.dtype) for x in columns[2:]]
        if goes_on:  # index -1 is the list that the last batch began
            for x, h in zip(hubs, hub[1:]):
                x[-1] = h
        hubs = [x[at] for x in hubs]
        several = np.zeros(len(lists), dtype=bool)
        several[:-1] |= lists[:-1] == lists[1:]
        several[1:] |= lists[1:] == lists[:-1]
        several[0] |= goes_on
        held = None if several[-1] else tuple(x[-1] for x in columns)
        hub = (lists[-1], *(x[-1] for x in hubs))
        several |= columns[0] != columns[1]
        if held is not None:
            several[-1] = False
        yield _hub_batch([x[several] for x in (*columns, *hubs)])
    if held is not None and held[0] != held[1]:
        yield _hub_batch([np.array([x]) for x in (*held, *held[2:])])


_HUBS = [*_POSTING, "hub", "hub_size", "hub_place"]
_HUB_TYPES = "list long, element long, class long, size int, place int, hub long, hub_size int, hub_place int"


def _hub_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], _HUBS)


def _least_overlap(a, b, percent: int):
    """Smallest intersection of sets of sizes a and b that reaches the threshold."""
    return -(-(percent * (a + b)) // (100 + percent))


def _across(percent: int):
    """Pairs of different components inside one block pair of a list that pass all filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lists(batches, "list"):
            key = batch.column("list").to_numpy()
            label, size, place, side = (batch.column(k).to_numpy() for k in ("label", "size", "place", "side"))
            cls = batch.column("class").to_numpy()
            hist = np.frombuffer(b"".join(batch.column("hist").to_pylist()), np.uint8).reshape(-1, _CLASSES).astype(np.int16)
            bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            left, right = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                rows = np.arange(lo, hi)
                one, two = rows[side[rows] <= 1], rows[side[rows] != 1]
                inner = bool((side[rows] == 0).all())
                for i in one:
                    to = two[two > i] if inner else two
                    to = to[label[to] != label[i]]
                    s, z = size[to].astype(np.int64), int(size[i])
                    need = _least_overlap(s, z, percent)
                    ok = (100 * np.minimum(s, z) >= percent * np.maximum(s, z)) & (1 + np.minimum(s - place[to], z - place[i]) - 1 >= need)
                    to, s, need = to[ok], s[ok], need[ok]
                    if len(to):
                        differ = np.abs(hist[to] - hist[i]).sum(axis=1)
                        to = to[differ <= s + z - 2 * need]
                        left.append(np.full(len(to), cls[i]))
                        right.append(cls[to])
            a = np.concatenate(left) if left else np.zeros(0, np.int64)
            b = np.concatenate(right) if right else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def _elements(n: int):
    """Class and complete set (sorted) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, "text"):
            r, g = _sets(data, offsets, n)
            sizes, cls = _classes(r, g, part.num_rows)
            packed = blobs(g.tobytes(), np.concatenate([[0], np.cumsum(sizes * 8)]))
            yield pa.RecordBatch.from_arrays([pa.array(cls), packed], ["class", "elements"])

    return run


def _shared(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets ``x`` with sets ``y``, by products of bounded 0-1 matrices."""
    out = np.zeros((len(x), len(y)), dtype=np.int64)
    a, b = np.concatenate(x), np.concatenate(y)
    row_a, row_b = (np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (x, y))
    common = np.intersect1d(a, b)
    if not len(common):
        return out
    at_a, at_b = (np.minimum(np.searchsorted(common, z), len(common) - 1) for z in (a, b))
    has_a, has_b = common[at_a] == a, common[at_b] == b
    row_a, at_a, row_b, at_b = row_a[has_a], at_a[has_a], row_b[has_b], at_b[has_b]
    for lo in range(0, len(common), _COLUMNS):
        width = min(_COLUMNS, len(common) - lo)
        one, two = np.zeros((len(x), width), np.float32), np.zeros((len(y), width), np.float32)
        for into, row, at in ((one, row_a, at_a), (two, row_b, at_b)):
            here = (at >= lo) & (at < lo + width)
            into[row[here], at[here] - lo] = 1
        out += np.rint(one @ two.T).astype(np.int64)
    return out


def _linked(percent: int):
    """Links of each class inside one block pair, weighted by the other class's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lists(batches, "list"):
            key, side, cls, times = (batch.column(k).to_numpy() for k in ("list", "side", "class", "times"))
            links = np.zeros(len(cls), dtype=np.int64)
            bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("elements").slice(lo, hi - lo)]
                sizes = np.array([len(v) for v in sets])
                one, two = np.flatnonzero(side[lo:hi] <= 1), np.flatnonzero(side[lo:hi] != 1)
                inner = bool((side[lo:hi] == 0).all())
                for i in range(0, len(one), _TILE):
                    for j in range(i if inner else 0, len(two), _TILE):
                        a, b = one[i : i + _TILE], two[j : j + _TILE]
                        shared = _shared([sets[k] for k in a], [sets[k] for k in b])
                        ok = 100 * shared >= percent * (sizes[a][:, None] + sizes[b][None] - shared)
                        if inner and i == j:
                            ok = np.triu(ok, 1)
                        links[lo + a] += ok @ times[lo + b]
                        links[lo + b] += times[lo + a] @ ok
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(links)], ["class", "links"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (class a < class b) whose complete sets reach the threshold, stored."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = ends.join(classes.select("class", F.col("first").alias("doc_id")), "class").select("doc_id").distinct()
    sets = stored(join_by(rows, wanted, ["doc_id"], "left_semi").mapInArrow(_elements(n), "class long, elements binary"), "jaccard_sets")
    one = pairs.join(sets.select(F.col("class").alias("a"), F.col("elements").alias("left")), "a")
    two = one.join(sets.select(F.col("class").alias("b"), F.col("elements").alias("right")), "b")
    # an id with several texts may bring a class twice
    return stored(two.select("a", "b", "left", "right").mapInArrow(_verify(percent), "a long, b long").distinct(), "jaccard_links")


def _joined(docs: DataFrame, n: int, percent: int, slots: int, list_block: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows, documents (``doc_id, size, class``), classes, and the ``node`` that stands for each class's component."""
    rows = doc_rows(docs)
    survey = stored(rows.mapInArrow(_survey(n, slots), "doc_id long, size long, class long, hist binary, block int, counts binary"), "jaccard_survey")
    members = survey.where("block IS NULL").select("doc_id", "size", "class")
    frequency = _frequencies(survey, slots)
    classes = survey.where("size > 0").groupBy("class").agg(F.min("doc_id").alias("first"), F.max("size").alias("size"), F.first("hist").alias("hist"))
    classes = stored(classes, "jaccard_classes")

    def hubs(postings: DataFrame, key: str) -> DataFrame:
        ordered = postings.repartition(key).sortWithinPartitions(key, "place", "size", "class")
        return ordered.select(F.col(key).alias("list"), "element", "class", "size", "place").mapInArrow(_hub_rows, _HUB_TYPES)

    lists = stored(hubs(rows.mapInArrow(_postings(n, percent, frequency), "list long, element long, class long, size int, place int"), "list"), "jaccard_lists")
    # the hubs of an element's salted lists meet in a list of their own
    salted = lists.where("list <> element AND class = hub").select("element", "class", "size", "place")
    stars = lists.unionByName(hubs(salted, "element"))
    long_enough = F.lit(100) * F.least("size", "hub_size") >= F.lit(percent) * F.greatest("size", "hub_size")
    overlap = F.ceil(F.lit(percent) * (F.col("size") + F.col("hub_size")) / F.lit(100.0 + percent) - 1e-9)
    near = F.least(F.col("size") - F.col("place"), F.col("hub_size") - F.col("hub_place")) >= overlap
    stars = stars.where((F.col("class") != F.col("hub")) & long_enough & near)
    stars = stored(stars.select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct(), "jaccard_stars")
    links = _verified(stored(_close(stars, classes, percent), "jaccard_close"), rows, classes, n, percent)
    labels = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))

    # lists that still hold several components
    labelled = join_by(lists.select("element", "class", "size", "place"), labels.select(F.col("node").alias("class"), "component"), ["class"], "left")
    labelled = stored(labelled.withColumn("label", F.coalesce("component", "class")).drop("component"), "jaccard_labelled")
    mixed = labelled.groupBy("element").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo <> hi")
    open_lists = join_by(labelled, mixed.select("element", "members"), ["element"], "inner")
    parts = F.ceil(F.col("members") / F.lit(list_block)).cast("int")
    block = F.pmod(F.xxhash64("class"), parts.cast("long")).cast("int")
    spread = (
        open_lists.withColumn("parts", parts)
        .withColumn("mine", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("list", F.xxhash64("element", F.least("mine", "other"), F.greatest("mine", "other")))
        .withColumn("side", F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2))
    )
    spread = spread.join(classes.select("class", "hist"), "class").select("list", "class", "label", "size", "place", "side", "hist")
    pairs = spread.repartition("list").sortWithinPartitions("list").mapInArrow(_across(percent), "a long, b long").distinct()
    more = _verified(stored(pairs, "jaccard_pairs"), rows, classes, n, percent)
    as_label = labels.select(F.col("node").alias("a"), "component")
    ends = join_by(more, as_label, ["a"], "left").select(F.coalesce("component", "a").alias("src"), "b")
    ends = join_by(ends, as_label.withColumnRenamed("a", "b"), ["b"], "left").select("src", F.coalesce("component", "b").alias("dst"))
    joined = components(ends)

    named = join_by(classes.select("class", "first"), labels.select(F.col("node").alias("class"), "component"), ["class"], "left")
    named = named.select("class", "first", F.coalesce("component", "class").alias("node"))
    named = join_by(named, joined.withColumnRenamed("component", "_top"), ["node"], "left").select("class", "first", F.coalesce("_top", "node").alias("node"))
    return rows, members, classes, stored(named, "jaccard_named")


def _named(members: DataFrame, named: DataFrame) -> DataFrame:
    """``doc_id, size, class, component_id`` of every document."""
    smallest = named.groupBy("node").agg(F.min("first").alias("component_id"))
    by_class = join_by(named.select("class", "node"), smallest, ["node"], "left").select("class", "component_id")
    out = join_by(members.distinct(), stored(by_class, "jaccard_by_class"), ["class"], "left")
    return out.withColumn("component_id", F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def jaccard_components(docs: DataFrame, *, n: int = 5, percent: int = 80, slots: int = FREQUENCY_SLOTS, list_block: int = LIST_BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id``: connected components of the links
    ``100 |x & y| >= percent |x | y|``, named by their smallest ``doc_id``."""
    _, members, _, named = _joined(docs, n, percent, slots, list_block)
    return _named(members, named).select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def jaccard_links(docs: DataFrame, *, n: int = 5, percent: int = 80, slots: int = FREQUENCY_SLOTS, list_block: int = LIST_BLOCK, set_bytes: int = SET_BYTES) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links``: as ``jaccard_components``, with the exact number
    of other documents each one is linked with."""
    rows, members, classes, named = _joined(docs, n, percent, slots, list_block)
    times = members.distinct().groupBy("class").agg(F.count(F.lit(1)).alias("times"))
    grouped = named.join(classes.select("class", "size"), "class")
    several = grouped.groupBy("node").agg(F.count(F.lit(1)).alias("_c"), F.sum("size").alias("_s")).where("_c > 1")
    parts = F.ceil(F.greatest(F.col("_c") / F.lit(list_block), F.col("_s") * 8 / F.lit(set_bytes))).cast("int")
    several = stored(several.select("node", parts.alias("parts")), "jaccard_several")
    chosen = stored(join_by(grouped, several, ["node"], "inner").join(times, "class").select("class", "first", "node", "parts", "times"), "jaccard_chosen")
    wanted = chosen.select(F.col("first").alias("doc_id")).distinct()
    sets = join_by(rows, wanted, ["doc_id"], "left_semi").mapInArrow(_elements(n), "class long, elements binary").dropDuplicates(["class"])
    # every pair of a component meets in one pair of its blocks
    spread = (
        chosen.join(sets, "class")
        .withColumn("mine", F.pmod(F.xxhash64("class"), F.col("parts").cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("list", F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")))
        .withColumn("side", F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2))
        .select("list", "side", "class", "times", "elements")
    )
    found = spread.repartition("list").sortWithinPartitions("list").mapInArrow(_linked(percent), "class long, links long")
    links = stored(found.groupBy("class").agg(F.sum("links").alias("links")), "jaccard_n_links")
    per_class = stored(times.join(links, "class", "left").select("class", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links")), "jaccard_per_class")
    out = join_by(_named(members, named), per_class, ["class"], "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), "component_id", F.when(F.col("size") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"))


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the suffix filter: histograms bound the symmetric difference."""
    one = pairs.join(classes.select(F.col("class").alias("a"), F.col("hist").alias("hist_a"), F.col("size").alias("size_a")), "a")
    two = one.join(classes.select(F.col("class").alias("b"), F.col("hist").alias("hist_b"), F.col("size").alias("size_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, _CLASSES).astype(np.int16) for k in ("hist_a", "hist_b"))
            a, b = (batch.column(k).to_numpy() for k in ("size_a", "size_b"))
            keep = np.abs(x - y).sum(axis=1) <= a + b - 2 * _least_overlap(a, b, percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return two.select("a", "b", "hist_a", "hist_b", "size_a", "size_b").mapInArrow(run, "a long, b long")
