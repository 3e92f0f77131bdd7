"""Toxicity by a weighted finite-state pattern grammar over clauses.

A clause is the text between sentence marks. Its words are read once by composed transducers:

* insult: a lexicon entry (whole word or stem) emits its weight;
* target: a person addressed within three words of the insult raises the weight;
* threat: intent, then a violent verb, then a target, each within four words, emits the threat weight;
* negation: within four words after a negation weights shrink;
* reported speech: after a verb of saying, or inside quotation marks, weights shrink.

Clauses, not words, are scored. The lexicon starts from a short list and is extended by words and
stems that labelled training rows show almost only in toxic texts; a logistic model over the clause
scores of a document gives the final score. Both are fitted on at most ``sample`` labelled rows in
hash order of their ids; copies and near copies (80 % of the 5-word shingles) with the same label
count once, so a copied document adds no entries.

Null and empty texts have no clauses and get the score of a text without matches. Each row is scored
on its own, so ties and repeated rows get equal scores; null ids count as held in for training only
if labelled (they never are) and are scored like others. Without labels, or with labels of one class,
the seed lexicon alone scores. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rankloom.llm.jaccard_join import jaccard_components
from rankloom.llm.kernels import ALNUM, LOWER, code_points, text_slices, word_spans
from rankloom.llm.tables import doc_rows, join_by, stored

SAMPLE = 20_000
FOLDS = 5
STEMS = (4, 5, 6)
MAX_ENTRIES = 5_000
NEAR_WORDS, NEAR_PERCENT = 5, 80

# fixed values: seed words of the grammar
INSULTS = (
    "idiot idiots idiotic moron morons loser losers scum clown trash garbage worthless pathetic stupid disgusting dumb imbecile retard vermin "
    "dummkopf arschloch abschaum versager widerlich connard imbécile ordure minable salaud estúpido idiota basura escoria imbécil asqueroso"
).split()
THREATS = "kill murder hurt strangle shoot stab beat destroy töten umbringen ermorden tuer frapper matar golpear".split()
INTENTS = "will gonna going shall must should werde wir'll vais voy going'll".split()
TARGETS = "you your you're u they them he she him her these those du dich dir ihr euch sie tu te vous toi tú usted ustedes ellos".split()
NEGATIONS = "not never no isn't aren't wasn't don't doesn't nobody nicht kein keine nie pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says say wrote writes claimed called quoted told reported sagte sagt schrieb dit écrit dijo dice escribió".split()
QUOTES = "\"“”„«»"

_CLAUSE_END = re.compile(r"[.!?;:\n]")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[\"“”„«»]")
_THREAT_WEIGHT = 2.0


@dataclass(frozen=True)
class Grammar:
    """Weights of whole words and of stems."""

    words: dict[str, float]
    stems: dict[str, float]

    def weight(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            found = max((self.stems.get(word[:n], 0.0) for n in STEMS), default=0.0)
        return found

    def keys(self) -> np.ndarray:
        """First four bytes, as a number, of every word that can begin a match in an ASCII clause."""
        heads = {term.encode()[:4].ljust(4, b"\0") for term in (*self.words, *self.stems, *THREATS)}
        return np.array(sorted(int.from_bytes(h, "little") for h in heads), dtype=np.uint32)


def clause_score(clause: str, grammar: Grammar) -> float:
    """Weight that the composed transducers emit for one clause."""
    total, negated, target_at, intent_at, threat_at = 0.0, 0, -99, -99, -99
    reported = quoted = False
    pending: list[tuple[int, float]] = []  # insults that a following target may still raise
    for i, token in enumerate(_WORD.findall(clause.lower())):
        if token in QUOTES:
            quoted = not quoted
            continue
        damp = (0.25 if negated else 1.0) * (0.35 if reported or quoted else 1.0)
        w = grammar.weight(token)
        if w > 0:
            if i - target_at <= 3:
                total += 1.5 * w * damp
            else:
                total += w * damp
                pending.append((i, 0.5 * w * damp))
        if token in TARGETS:
            target_at = i
            total += sum(extra for at, extra in pending if i - at <= 3)
            pending.clear()
            if i - threat_at <= 4:
                total += _THREAT_WEIGHT * damp
                threat_at = -99
        elif token in INTENTS:
            intent_at = i
        elif token in THREATS and i - intent_at <= 4:
            threat_at = i
        negated = 4 if token in NEGATIONS else max(0, negated - 1)
        reported = reported or token in REPORTS
    return total


def _clauses(text: str, positions: list[int]) -> Iterator[str]:
    """The clauses around ascending positions, each once."""
    end = -1
    for p in positions:
        if p < end:
            continue
        m = None
        start = max(text.rfind(mark, max(end, 0), p) for mark in ".!?;:\n") + 1
        start = max(start, max(end, 0))
        m = _CLAUSE_END.search(text, p)
        end = m.start() if m else len(text)
        yield text[start:end]


def document_features(text: str, positions: list[int], grammar: Grammar, n_words: int) -> list[float]:
    """Features of the clauses around ascending positions (code points)."""
    scores = [s for c in _clauses(text, positions) if (s := clause_score(c, grammar)) > 0]
    if not scores:
        return [0.0, 0.0, 0.0, 0.0]
    return [math.log1p(sum(scores)), min(max(scores), 8.0), math.log1p(len(scores)), math.log1p(1000 * len(scores) / max(n_words, 1))]


def _candidates(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Bytes whose clauses may score: runs that begin like a match, and everything beyond ASCII.

    Bytes tell the grammar's words only in ASCII clauses; a clause with other characters (which may
    be letters, quotation marks or spaces) is always scored.
    """
    padded = np.concatenate([LOWER[data], np.zeros(4, np.uint8)])
    head = np.zeros(len(starts), dtype=np.uint32)
    for i in range(4):
        head |= np.where(starts + i < ends, padded[starts + i], 0).astype(np.uint32) << np.uint32(8 * i)
    beyond = data >= 0xC0  # first bytes of their characters
    beyond[starts[np.isin(head, keys)]] = True
    return np.flatnonzero(beyond)


def _features(grammar: Grammar, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = grammar.keys()
        for part, data, offsets in text_slices(batches, "text"):
            starts, ends, row = word_spans(data, offsets, ALNUM)
            hit = _candidates(data, starts, ends, keys)
            out = np.zeros((part.num_rows, 4))
            n_words = np.bincount(row, minlength=part.num_rows)
            texts = part.column("text")
            chars = code_points(data, offsets)
            bounds = np.searchsorted(hit, offsets)
            for r in np.flatnonzero(np.diff(bounds)):
                at = chars[hit[bounds[r] : bounds[r + 1]]] - chars[offsets[r]]
                out[r] = document_features(texts[int(r)].as_py(), at.tolist(), grammar, int(n_words[r]))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(out[:, i]) for i in range(4))], [*keep, "f0", "f1", "f2", "f3"])

    return run


_FEATURE_TYPES = "f0 double, f1 double, f2 double, f3 double"


def held_out(doc_id: Column, remainder: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == remainder, F.lit(False))


def _distinct(texts: DataFrame) -> DataFrame:
    """``doc_id`` (a hash of the text), ``text, toxic``: one row for each label and group of near copies.

    Near copies are told by the exact join, so different texts that share some words all stay.
    """
    texts = texts.select(F.xxhash64("text").alias("doc_id"), "text", "toxic").dropDuplicates(["doc_id", "toxic"])
    texts = stored(texts, "toxicity_labelled")
    groups = jaccard_components(texts, n=NEAR_WORDS, percent=NEAR_PERCENT).select("doc_id", "component_id")
    first = join_by(texts.select("doc_id", "toxic"), groups, ["doc_id"], "inner").groupBy("toxic", "component_id").agg(F.min("doc_id").alias("doc_id"))
    first = stored(first.select("doc_id", "toxic"), "toxicity_first")
    return stored(join_by(texts, first, ["doc_id", "toxic"], "left_semi"), "toxicity_sample")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    rows = 0
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(re.findall(r"[^\W\d_]+", text.lower()))
            terms = {f"={w}" for w in words}
            for n in STEMS:
                terms |= {w[:n] for w in words if len(w) > n}
            counts[toxic].update(terms)
            rows += 1
            if rows % 100 == 0:
                yield _counted(counts)
    yield _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    terms = list({*counts[0], *counts[1]})
    batch = pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())], ["term", "toxic", "clean"]
    )
    counts[0].clear()
    counts[1].clear()
    return batch


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Penalised logistic weights, intercept last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    grammar: Grammar
    weights: tuple[float, ...]


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, min_share: float = 0.02, min_odds: float = 3.0) -> ToxicityModel:
    """Learn lexicon and weights from labelled rows outside the held-out fold.

    An entry must occur in ``min_share`` of the distinct toxic sample texts (and four of them) and
    be ``exp(min_odds)`` times as likely there as in the clean ones. Several labels of a document
    count as toxic if one is. The lexicon keeps ``MAX_ENTRIES`` entries at most (model size).
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    chosen = marked.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = doc_rows(docs).join(F.broadcast(chosen), "doc_id")  # at most `sample` rows of 12 bytes
    texts = _distinct(texts)
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    words, stems = dict.fromkeys(INSULTS, 1.0), {}
    if sizes.get(0) and sizes.get(1):
        odds = F.log((F.col("toxic") + 0.5) / F.lit(sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(sizes[0] + 1.0))
        learned = (
            texts.mapInArrow(_term_counts, "term string, toxic long, clean long")
            .groupBy("term")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where(F.col("toxic") >= max(4, math.ceil(min_share * sizes[1])))
            .withColumn("odds", odds)
            .where(F.col("odds") >= min_odds)
            .orderBy(F.col("odds").desc(), "term")
            .limit(MAX_ENTRIES)
            .collect()
        )
        for r in learned:
            if r["term"].startswith("="):
                words[r["term"][1:]] = r["odds"] / min_odds
            else:
                stems[r["term"]] = r["odds"] / min_odds
    grammar = Grammar(words, stems)
    if not (sizes.get(0) and sizes.get(1)):
        return ToxicityModel(grammar, (1.0, 1.0, 0.0, 0.0, -2.0))
    rows = texts.mapInArrow(_features(grammar, ["toxic"]), f"toxic int, {_FEATURE_TYPES}").collect()  # at most `sample` rows
    data = np.array([tuple(r) for r in rows], dtype=float)
    return ToxicityModel(grammar, tuple(float(w) for w in _logistic(data[:, 1:], data[:, 0])))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    rows = doc_rows(docs).mapInArrow(_features(model.grammar, ["doc_id"]), f"doc_id long, {_FEATURE_TYPES}")
    *weights, intercept = model.weights
    linear = F.lit(intercept)
    for i, w in enumerate(weights):
        linear = linear + F.lit(w) * F.col(f"f{i}")
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), (1 / (1 + F.exp(-linear))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
