"""Personal data: fixed patterns, and terms that the corpus shows to disclose them.

Base entities are e-mail and IP addresses, payment cards and phone numbers, matched left-most and
non-overlapping per kind; a match that fails its check is dropped.

Terms: each mention of an entity has a context, the ``window`` words on each side. All numbers count
distinct texts: ``N`` of them, ``n(e)`` holding entity ``e``, ``n(t)`` holding term ``t`` and ``n(e,t)``
with ``t`` in a context of ``e``. The share of the information of ``e`` that ``t`` gives away is

    disclosure(t, e) = log2(N p / n(e)) / log2(N / n(e))

where ``p`` is the lower end of Wilson's interval (``z`` standard errors) of the share ``n(e,t) / n(t)``,
so few texts weigh less but are not left out. A term with a disclosure of ``generalise_at`` or more is
generalised to a placeholder wherever it occurs, from ``remove_at`` on it is removed. Copies of a text
count once on all sides, so copying a page changes nothing.

A context has a fixed number of words, so counting is linear in the mentions; no pairs of documents
or of terms are formed. Terms that could be disclosive if they stood nowhere else are counted over
all texts, summed in each task; only occurrences of disclosive terms become rows. Both scans know
their terms by a Bloom filter of fixed size, and exact joins follow.

Null and empty texts have no spans. Documents with the same id and text are one row in
``find_spans``; ``sanitise`` keeps every row. Ids may be null. Extra columns are kept by ``sanitise``
and not read otherwise.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rankloom.llm.kernels import ALNUM, LOWER, code_points, ragged, span_hashes, text_slices, word_spans
from rankloom.llm.tables import bloom_words, doc_rows, in_bloom, join_by, stored

KINDS = ("email", "ip", "card", "phone")
WINDOW = 6
Z = 1.645  # one-sided 95 %
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
MIN_TERM_CHARS = 2
BLOOM_BITS = 1 << 24
_SLICE_BITS = 8

# the local part is found backwards from each @, so that long runs without one cost nothing
_LOCAL_BACKWARDS = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MANY = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        local = _LOCAL_BACKWARDS.match(text[done:at][::-1])
        domain = _DOMAIN.match(text, at + 1) if local else None
        if local and domain:
            yield at - local.end(), domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, by kind and start."""
    if not _MANY.search(text):
        return []
    out = [(0, s, e) for s, e in _emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def spans_string(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _entity(kind: int, value: str) -> int:
    value = value.lower() if kind < 2 else _digits(value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


_BASE_TYPES = "doc_id long, key long, n_email long, n_ip long, n_card long, n_phone long, base string, contexts array<struct<e:long,t:long>>"


def _find_base(window: int):
    """Base spans of every row, and one ``(entity, term)`` for every term near a mention."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, "text"):
            counts = np.zeros((4, part.num_rows), dtype=np.int64)
            base, entities, terms, per_row = [], [], [], np.zeros(part.num_rows, np.int64)
            for r, text in enumerate(part.column("text").to_pylist()):
                spans = base_spans(text)
                base.append(spans_string(spans))
                if not spans:
                    continue
                for k, _, _ in spans:
                    counts[k, r] += 1
                raw = LOWER[data[offsets[r] : offsets[r + 1]]]
                starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), ALNUM)
                chars = code_points(raw, offsets)
                first, last = chars[starts], chars[ends]
                inside = np.zeros(len(starts), dtype=bool)
                for _, s, e in spans:
                    inside[np.searchsorted(last, s, side="right") : np.searchsorted(first, e)] = True
                free = np.flatnonzero(~inside)
                words = span_hashes(raw, starts[free], ends[free])
                long_enough = (last - first)[free] >= MIN_TERM_CHARS
                for k, s, e in spans:
                    at = int(np.searchsorted(first[free], s))
                    near = slice(max(at - window, 0), at + window)
                    found = np.unique(words[near][long_enough[near]])
                    entities += [_entity(k, text[s:e])] * len(found)
                    terms += found.view(np.int64).tolist()
                    per_row[r] += len(found)
            bounds = np.zeros(part.num_rows + 1, dtype=np.int32)
            np.cumsum(per_row, out=bounds[1:])
            structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (entities, terms)], ["e", "t"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), *(pa.array(counts[k]) for k in range(4)), pa.array(base, pa.string()), pa.ListArray.from_arrays(pa.array(bounds), structs)],
                ["doc_id", "key", *(f"n_{k}" for k in KINDS), "base", "contexts"],
            )

    return run


def _find_terms(bloom: np.ndarray):
    """Occurrences of terms that may be candidates: one row per document and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, "text"):
            lower = LOWER[data]
            starts, ends, row = word_spans(lower, offsets, ALNUM)
            words = span_hashes(lower, starts, ends)
            chars = code_points(data, offsets)
            hit = np.flatnonzero(in_bloom(bloom, words) & (chars[ends] - chars[starts] >= MIN_TERM_CHARS))
            order = hit[np.lexsort((starts[hit], words[hit], row[hit]))]
            r, w = row[order], words[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(order)))
            origin = chars[offsets[:-1]][r]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(r[first])),
                    part.column("key").take(pa.array(r[first])),
                    pa.array(w[first].view(np.int64)),
                    ragged((chars[starts[order]] - origin).astype(np.int32), counts, pa.int32()),
                    ragged((chars[ends[order]] - origin).astype(np.int32), counts, pa.int32()),
                ],
                ["doc_id", "key", "t", "starts", "ends"],
            )

    return run


def _count_terms(bloom: np.ndarray):
    """Texts of the task that hold each term of the filter; each of ``times`` copies is a share of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.zeros(0, np.uint64), np.zeros(0)
        for part, data, offsets in text_slices(batches, "text"):
            lower = LOWER[data]
            starts, ends, row = word_spans(lower, offsets, ALNUM)
            words = span_hashes(lower, starts, ends)
            chars = code_points(data, offsets)
            hit = np.flatnonzero(in_bloom(bloom, words) & (chars[ends] - chars[starts] >= MIN_TERM_CHARS))
            share = 1 / part.column("times").to_numpy()
            order = hit[np.lexsort((words[hit], row[hit]))]
            r, w = row[order], words[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
            terms, at = np.unique(np.concatenate([terms, w[new]]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, share[r[new]]]), minlength=len(terms))
            if len(terms) > 500_000:
                yield _sliced(terms, counts)
                terms, counts = np.zeros(0, np.uint64), np.zeros(0)
        yield _sliced(terms, counts)

    return run


def _sliced(terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Ascending terms with their counts, one row per range of terms: tasks know much the same terms, and a row for each
    term of each task would outgrow the texts."""
    cuts = np.searchsorted(terms >> np.uint64(64 - _SLICE_BITS), np.arange(1, 1 << _SLICE_BITS))
    bounds = np.concatenate([[0], cuts, [len(terms)]])
    used = np.flatnonzero(np.diff(bounds))
    part = lambda a: pa.array([a[bounds[i] : bounds[i + 1]].tobytes() for i in used], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), part(terms), part(counts)], ["slice", "t", "n"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed counts of the terms of a partition, whose slices are whole."""
    terms, counts = np.zeros(0, np.uint64), np.zeros(0)
    for batch in batches:
        more = np.frombuffer(b"".join(batch.column("t").to_pylist()), np.uint64)
        numbers = np.frombuffer(b"".join(batch.column("n").to_pylist()))
        terms, at = np.unique(np.concatenate([terms, more]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([counts, numbers]), minlength=len(terms))
    yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], ["t", "n"])


def _found(docs: DataFrame, window: int, z: float, generalise_at: float, remove_at: float, bloom_bits: int) -> tuple[DataFrame, DataFrame]:
    """Base rows of all documents, and ``doc_id, key, terms`` of those with disclosive terms."""
    rows = doc_rows(docs).withColumn("key", F.xxhash64("text"))
    base = stored(rows.mapInArrow(_find_base(window), _BASE_TYPES), "pii_base")
    mentions = base.select("key", F.explode("contexts").alias("x")).select("key", "x.*")
    n = float(base.select("key").distinct().count())
    n_e = stored(mentions.select("e", "key").distinct().groupBy("e").agg(F.count(F.lit(1)).alias("n_e")), "pii_entities")
    information = F.log2(F.lit(n) / F.col("n_e"))

    def disclosure(n_t: Column) -> Column:
        share, error = F.least(F.col("n_et") / n_t, F.lit(1.0)), F.lit(z * z) / n_t
        low = (share + error / 2 - F.lit(z) * F.sqrt(share * (1 - share) / n_t + error / (4 * n_t))) / (1 + error)
        return F.when((information > 0) & (low > 0), (information + F.log2(low)) / information).otherwise(0.0)

    pairs = mentions.select("e", "t", "key").distinct().groupBy("e", "t").agg(F.count(F.lit(1)).alias("n_et"))
    pairs = stored(pairs.join(n_e, "e").where(disclosure(F.col("n_et")) >= generalise_at), "pii_pairs")
    copies = stored(base.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "pii_copies")
    weighed = join_by(rows, copies, ["key"], "left").select("text", F.coalesce("times", F.lit(1)).alias("times"))
    sliced = weighed.mapInArrow(_count_terms(bloom_words(pairs, "t", bloom_bits)), "slice int, t binary, n binary")
    counted = sliced.repartition("slice").mapInArrow(_merged, "t long, n double")
    n_t = counted.groupBy("t").agg(F.round(F.sum("n")).alias("n_t"))
    flagged = (
        pairs.join(n_t, "t")
        .withColumn("disclosure", disclosure(F.col("n_t")))
        .groupBy("t")
        .agg(F.max("disclosure").alias("disclosure"))
        .where(F.col("disclosure") >= generalise_at)
    )
    flagged = stored(flagged, "pii_flagged")
    occurrences = rows.mapInArrow(_find_terms(bloom_words(flagged, "t", bloom_bits)), "doc_id long, key long, t long, starts array<int>, ends array<int>")
    terms = (
        join_by(occurrences, flagged, ["t"], "inner")
        .select("doc_id", "key", (F.col("disclosure") >= remove_at).alias("gone"), F.explode(F.arrays_zip("starts", "ends")).alias("p"))
        .groupBy("doc_id", "key")
        .agg(F.sort_array(F.collect_set(F.struct(F.col("p.starts").alias("s"), F.col("p.ends").alias("e"), "gone"))).alias("terms"))
    )
    return base, stored(terms, "pii_terms")


def find_spans(
    docs: DataFrame,
    *,
    window: int = WINDOW,
    z: float = Z,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, terms``: ``base`` as kind:start:end,…; ``terms``
    an array of ``(s, e, gone)`` in code points that lie outside the base spans."""
    base, terms = _found(docs, window, z, generalise_at, remove_at, bloom_bits)
    none = F.array().cast("array<struct<s:int,e:int,gone:boolean>>")
    joined = join_by(base.drop("contexts").distinct(), terms, ["doc_id", "key"], "left").withColumn("terms", F.coalesce("terms", none))
    taken = F.transform(F.split("base", ","), lambda x: F.struct(F.split(x, ":")[1].cast("int").alias("s"), F.split(x, ":")[2].cast("int").alias("e")))
    outside = F.filter("terms", lambda t: ~F.exists(F.col("_taken"), lambda b: (t["s"] < b["e"]) & (b["s"] < t["e"])))
    joined = joined.withColumn("_taken", F.when(F.col("base") == "", F.array().cast("array<struct<s:int,e:int>>")).otherwise(taken))
    return joined.withColumn("terms", F.when(F.size("terms") > 0, outside).otherwise(F.col("terms"))).drop("_taken", "key")


def redact(text: str, terms: list[dict]) -> str:
    """Text with base spans as [KIND] and terms removed or generalised; overlaps merge into the first."""
    spans = [(s, e, f"[{KINDS[k].upper()}]") for k, s, e in base_spans(text)]
    spans += [(t["s"], t["e"], "" if t["gone"] else "[TERM]") for t in terms]
    if not spans:
        return text
    spans.sort()
    out, at, stop = [], 0, 0
    for s, e, mark in spans:
        if s >= stop:
            out += [text[at:s], mark]
        at = stop = max(stop, e)
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame,
    *,
    text_col: str = "text",
    window: int = WINDOW,
    z: float = Z,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """``docs`` with all its columns and rows, personal data and disclosive terms taken out of the text."""
    _, terms = _found(docs.withColumnRenamed(text_col, "text"), window, z, generalise_at, remove_at, bloom_bits)
    columns = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    keyed = docs.select(whole, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    joined = join_by(keyed, terms, ["doc_id", "key"], "left")
    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                fields = part.column("row").flatten()
                at = columns.index(text_col)
                texts = fields[at].to_pylist()
                fields[at] = pa.array([None if t is None else redact(t, x or []) for t, x in zip(texts, part.column("terms").to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays(fields, columns)

    return joined.select("row", "terms").mapInArrow(run, schema)
