"""What each operator states for repeated rows, null ids, empty and long texts and clashing column names."""

import random
from collections import Counter

import public_tokenizers as P
import pytest

from rankloom.llm import byte_bpe, context_tree, decontaminate, jaccard_join, kneser_ney, pii, repeated_spans, token_files, toxicity

WORDS = [a + b + c for a in "bdfgklmn" for b in ("ara", "eno", "ilo") for c in "bdfgklmn"]
#: names that operators use inside, and one with a dot
SCHEMA = "doc_id long, text string, `a.b` int, key string, class string, page long, shard int, kind string, held_out string, list int, terms string"
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choices(WORDS, k=n))
    one, two, long = text(40), text(60), text(15_000)
    rows = [(1, one), (1, one), (1, two), (2, one), (None, one), (None, one), (None, two), (3, None), (4, ""), (5, " \t\n"), (6, long), (6, long), (7, long + " tail")]
    return rows + [(10 + i, text(30)) for i in range(20)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, n, "k", "c", 1, 2, "x", "h", 3, "t") for n, (i, t) in enumerate(texts)], SCHEMA).repartition(3)


def labels(spark):
    return spark.createDataFrame([(10 + i, 1, int(i % 5 == 0)) for i in range(10)], LABELS)


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_operators_that_keep_every_row(spark, docs, texts, tmp_path):
    every = Counter(i for i, _ in texts)
    scored = context_tree.score_texts(docs, depth=3).collect()
    judged = toxicity.score(docs, toxicity.fit(docs, labels(spark))).collect()
    quality = kneser_ney.quality(docs.withColumnRenamed("kind", "lang"), labels(spark)).collect()
    tokens = byte_bpe.encode(docs, RANKS, P.PATTERN).collect()
    spans = repeated_spans.remove_repeats(docs).collect()
    files = token_files.read_tokens(token_files.write_tokens(docs, P.path("word_bpe_49k.json"), str(tmp_path / "t"), end_id=2, shard_bytes=50_000)).collect()
    for rows in (scored, judged, quality, tokens, spans, files):
        assert ids(rows) == every
    # equal texts, equal scores, whatever their id
    by_text = {}
    for (i, t), got in ((r, g) for r in texts for g in scored if g.doc_id == r[0]):
        by_text.setdefault(t, set()).add((len((t or "").encode()), got.n_tokens))
    n_bytes = {t: len((t or "").encode()) for _, t in texts}
    assert sorted(r.n_bytes for r in spans) == sorted(n_bytes[t] for _, t in texts)
    # a repeated id is not smaller than itself, and a null one neither takes nor gives
    assert all(r.n_removed == 0 for r in spans if r.doc_id in (None, 1, 3, 4, 5))
    assert [r.n_removed for r in spans if r.doc_id == 2] == [n_bytes[texts[0][1]]]
    assert sorted(r.n_removed for r in spans if r.doc_id in (6, 7)) == [0, 0, n_bytes[texts[10][1]]]
    starts = sorted((r.start, r.n_tokens) for r in files)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]
    assert [r.doc_id for r in sorted(files, key=lambda r: r.start)][:3] == [None] * 3  # null ids come first


def test_operators_that_merge_equal_rows(spark, docs, texts):
    distinct = Counter(i for i, _ in set(texts))
    bench = spark.createDataFrame([(1, texts[0][1]), (1, texts[0][1]), (None, texts[2][1]), (3, None), (4, "")], "item_id long, text string")
    found = decontaminate.contamination(docs, bench).collect()
    assert ids(found) == distinct
    assert sorted((r.doc_id or 0, r.n_hit) for r in found if r.contaminated) == [(0, 40), (0, 60), (1, 40), (1, 60), (2, 40)]
    assert ids(pii.find_spans(docs).collect()) == distinct
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and ids(clean.collect()) == Counter(i for i, _ in texts)
    groups = jaccard_join.jaccard_components(docs, n=3, percent=90).collect()
    root = {(r.doc_id, r.n_shingles): r.component_id for r in groups}
    assert set(ids(groups)) == {i for i, _ in texts}
    assert root[2, 38] == 1 and root[None, 38] == 1 and root[7, max(n for i, n in root if i == 7)] == 6
    assert all(root[i, 0] == i for i in (3, 4, 5))


def test_empty_tables(spark, docs, tmp_path):
    none = docs.where("false")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for out in (
        decontaminate.contamination(none, bench),
        decontaminate.contamination(none, bench.where("false")),
        pii.find_spans(none),
        pii.sanitise(none),
        jaccard_join.jaccard_components(none, n=3, percent=90),
        jaccard_join.jaccard_links(none, n=3, percent=90),
        kneser_ney.quality(none.withColumnRenamed("kind", "lang"), labels(spark)),
        toxicity.score(none, toxicity.fit(none, labels(spark).where("false"))),
        byte_bpe.decode(byte_bpe.encode(none, RANKS, P.PATTERN), RANKS),
        repeated_spans.remove_repeats(none),
        context_tree.score_texts(none),
    ):
        assert out.count() == 0
    assert decontaminate.contamination(docs, bench.where("false")).where("contaminated").count() == 0
