"""The ten operators against brute force on awkward rows: nulls, empties, copies, long texts, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankloom.llm import byte_bpe, context_tree, decontaminate, jaccard_join, kneser_ney, pii, product_quantiser, repeated_spans, token_files, toxicity
from rankloom.llm.kernels import ALNUM, span_hashes, word_spans
from rankloom.llm.tables import components

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = "the of and red blue green stone river cloud lamp é漢 zeta".split()
SCHEMA = "doc_id long, text string, key string, n int, size string, component string, list string"


def texts():
    rnd = random.Random(4)
    base = [" ".join(rnd.choices(WORDS, k=rnd.randint(1, 60))) for _ in range(12)]
    out = {0: None, 1: "", 2: " \n\t", 3: "word", 4: "a" * 9000, 5: "mail a.b@c.de or +49 (30) 123-4567, 10.0.0.256, 10.0.0.1, 4111 1111 1111 1111"}
    for i in range(6, 60):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        out[i] = " ".join(words)
    out[60] = "x".join(out[7] for _ in range(30))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "k", 1, "s", "c", "l") for i, t in docs.items()], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return texts()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontamination(spark, docs):
    items = {1: " ".join(docs[7].split()[:14]), 2: "stone river", 3: None, 4: "", 5: docs[60][:400]}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = {i: {tuple(w[p : p + min(10, len(w))]) for p in range(len(w) - min(10, len(w)) + 1)} for i, t in items.items() if (w := words(t))}
    got = {r.doc_id: r for r in decontaminate.contamination(frame(spark, docs), bench).collect()}
    assert len(got) == len(docs)
    for i, t in docs.items():
        w, hit, found = words(t), set(), set()
        for item, wins in windows.items():
            for n in {len(x) for x in wins}:
                for p in range(len(w) - n + 1):
                    if tuple(w[p : p + n]) in wins:
                        hit.update(range(p, p + n))
                        found.add(str(item))
        want = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256) == want, i
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    assert not decontaminate.contamination(frame(spark, docs), bench.limit(0)).where("contaminated").count()


def test_pii(spark, docs):
    assert [(pii.KINDS[k], docs[5][s:e]) for k, s, e in pii.base_spans(docs[5])] == [
        ("email", "a.b@c.de"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 123-4567")
    ]
    rows = {r.doc_id: r for r in pii.find_spans(frame(spark, docs)).collect()}
    assert (rows[5].n_email, rows[5].n_ip, rows[5].n_card, rows[5].n_phone) == (1, 1, 1, 1) and rows[0].base == ""
    clean = pii.sanitise(frame(spark, docs))
    assert clean.columns == SCHEMA.replace(",", "").split()[::2] and clean.count() == len(docs)
    after = {r.doc_id: r.text for r in clean.collect()}
    assert after[5] == "mail [EMAIL] or [PHONE], 10.0.0.256, [IP], [CARD]" and after[0] is None
    assert pii.sanitise(empty(spark)).count() == 0


def test_disclosive_terms(spark):
    rnd = random.Random(1)
    rows = {i: " ".join(rnd.choices("alpha beta gamma delta kappa omega".split(), k=12)) for i in range(300)}
    for i in range(5):
        rows[i] += f" zanzibar {rnd.random()} {WORDS[i]}{i} boss@corp.com"
    found = {r.doc_id: r.terms for r in pii.find_spans(frame(spark, rows)).collect()}
    for i in range(300):
        assert [rows[i][t.s : t.e] for t in found[i]] == (["zanzibar"] if i < 5 else [])


def test_disclosive_terms_of_copies_and_footers(spark):
    rnd = random.Random(2)
    filler = "alpha beta gamma delta kappa omega".split()
    rows = {i: " ".join(rnd.choices(filler, k=12)) for i in range(2000)}
    for i in range(6):  # a footer: one context, several texts
        rows[i] += " quorn Ng ceo@corp.com"
    for i in range(10, 210):  # a page copied often, and two more texts
        rows[i] = "alpha beta zanzibar boss@corp.com"
    rows[210] += " zanzibar kappa boss@corp.com"
    rows[211] += " zanzibar gamma boss@corp.com"
    rows[300] += " hapax one@corp.com"
    found = {r.doc_id: [rows[r.doc_id][t.s : t.e] for t in r.terms] for r in pii.find_spans(frame(spark, rows)).collect()}
    assert found[0] == ["quorn", "Ng"] and found[10] == found[210] == found[211] == ["zanzibar"] and found[300] == ["hapax"]
    assert not any(found[i] for i in range(400, 2000))


@pytest.mark.parametrize("n, percent, slots, salt", [(3, 90, 1 << 17, 4096), (3, 60, 1 << 16, 2), (5, 80, 1 << 16, 4096)])
def test_jaccard(spark, docs, monkeypatch, n, percent, slots, salt):
    monkeypatch.setattr(jaccard_join, "_SALT_ROWS", salt)
    sets = {}
    for i, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[i] = {tuple(w[p : p + n]) for p in range(max(len(w) - n, 0) + 1)} if w else set()
    top = {i: i for i in docs}
    for _ in docs:
        for a in docs:
            for b in docs:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    top[a] = top[b] = min(top[a], top[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, docs), n=n, percent=percent, slots=slots, list_block=4).collect()}
    assert got == {i: (len(sets[i]), top[i]) for i in docs}


@pytest.mark.parametrize("percent, set_bytes", [(60, 2000)])
def test_jaccard_links(spark, docs, monkeypatch, percent, set_bytes):
    monkeypatch.setattr(jaccard_join, "_TILE", 3)
    monkeypatch.setattr(jaccard_join, "_COLUMNS", 7)
    sets = {}
    for i, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[i] = {tuple(w[p : p + 3]) for p in range(max(len(w) - 3, 0) + 1)} if w else set()
    want = {a: sum(a != b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) for b in docs if sets[b]) if sets[a] else 0 for a in docs}
    got = {r.doc_id: r.n_links for r in jaccard_join.jaccard_links(frame(spark, docs), n=3, percent=percent, list_block=4, set_bytes=set_bytes).collect()}
    assert got == want and max(want.values()) > 3


def test_jaccard_empty(spark):
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_components_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "src long, dst long")
    assert {r.node: r.component for r in components(edges).collect()} == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def linked(x, threshold=0.9):
    """Numbers of links and smallest reachable positions, by brute force."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    root = np.arange(len(x))
    while (root != (new := np.where(near, root[None, :], len(x)).min(axis=1))).any():
        root = new
    return near.sum(axis=1) - 1, root


@pytest.mark.parametrize("reach", [product_quantiser.REACH, None])
def test_product_quantiser(spark, reach):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    x[100:160] = x[0] + rng.normal(size=(60, 16)) * 0.3
    x[200:220] = x[1]
    narrow = np.vstack([rng.normal(size=(1, 2)).repeat(2, axis=0), rng.normal(size=(40, 2))])
    extreme = np.array([[1e-200, 2e-200, 0], [1e200, 2e200, 0], [1.0, -2.0, 1e-300], [5e-324, 1e-323, 0]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500 + i, v.tolist()) for i, v in enumerate(narrow)] + [(600 + i, v.tolist()) for i, v in enumerate(extreme)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0]), (904, []), (905, [1.0, None]), (906, [float("inf"), 1.0])]
    rows += [(None, [7.0, 7.0, 7.0, 7.0]), (700, [1.0, 1.0, 1.0, 1.0]), (700, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("class", F.lit("c")).withColumn("width", F.lit("w")).withColumn("list", F.lit(1))
    out = product_quantiser.near_duplicates(df, block=32, reach=reach).collect()
    got = {r.vec_id: r for r in out}
    assert len(out) == len(rows)
    for first, some in ((0, x), (500, narrow), (600, extreme)):
        links, root = linked(some)
        found = np.array([got[first + i].n_links for i in range(len(some))])
        assert (found <= links).all() and found.sum() >= (0.99 if reach else 1) * links.sum()
        if (found == links).all():
            assert [(got[first + i].component_id, got[first + i].kept) for i in range(len(some))] == [(first + r, r == i) for i, r in enumerate(root.tolist())]
    assert got[600].n_links == 2 and got[602].n_links == 0 and (np.array([got[i].n_links for i in range(200, 220)]) >= 20).all()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(900, 907))
    # repeated and null ids keep their rows and link like others
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in out if r.vec_id in (None, 700)) == [(0, 2, 700), (700, 2, 700), (700, 2, 700)]
    assert product_quantiser.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [0.9, 0.8, 0.5])
def test_product_quantiser_probes_every_link(threshold):
    """Two vectors at the threshold, mirrored at the plane between two cells, find each other."""
    cos = threshold + 1e-9
    one, two = (np.array([(1 + cos) ** 0.5, s * (1 - cos) ** 0.5]) / 2**0.5 for s in (1, -1))
    quantiser = product_quantiser.Quantiser(np.array([[0.5, 0.4], [0.5, -0.4]]), np.zeros((1, 1, 2)), np.array([0, 2]))
    x = np.array([one, two])
    lists = quantiser.encode(x)[0]
    probes = quantiser.probes(x, lists, product_quantiser._margin(threshold, 2))
    assert lists[0] != lists[1] and (lists[1] in probes[0] or lists[0] in probes[1])


def test_toxicity(spark):
    rnd = random.Random(3)
    rows, labels = {}, []
    for i in range(300):
        words = rnd.choices([a + b for a in "bcdfglmn" for b in ("ara", "eno", "ilo", "otu", "ume") for _ in "x"], k=40)
        words = [w + rnd.choice("bcdfglmn") + rnd.choice("aeiou") + rnd.choice("bcdfglmn") for w in words]
        if toxic := i % 4 == 0:
            for p in rnd.sample(range(40), 4):
                words[p] = "grumpf" + rnd.choice(["en", "ist", "o"])
        rows[i] = " ".join(words)
        labels.append((i, int(toxic)))
    rows |= {900: None, 901: ""}
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(frame(spark, rows), model).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and np.mean([got[i].predicted == dict(labels)[i] for i in held]) > 0.95
    assert got[900].score == got[901].score and got[900].predicted == 0
    g = model.grammar
    assert toxicity.clause_score("you idiot", g) > toxicity.clause_score("idiot", g) > toxicity.clause_score("not an idiot", g) > 0
    assert toxicity.clause_score("he said idiot", g) < toxicity.clause_score("idiot", g)
    assert toxicity.clause_score("i will kill you", g) > 0 and toxicity.clause_score("kill the lamp", g) == 0
    none = toxicity.fit(frame(spark, rows), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(empty(spark), none).count() == 0


def test_toxicity_sample_keeps_different_texts(spark):
    """All texts share one word of extreme hash; only true copies and near copies fall out of the fit."""
    vocabulary = [a + b + c for a in "bdfgklmn" for b in ("ara", "eno", "ilo") for c in "bdfgklmn"]
    hashes = toxicity_hashes(vocabulary)
    common = [vocabulary[int(np.argmin(hashes))], vocabulary[int(np.argmax(hashes))]]
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices(vocabulary, k=40) + common), i % 2) for i in range(60)]
    rows += [(60, rows[0][1], 0), (61, rows[0][1] + " tail", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = [(r.toxic, r.text.removesuffix(" tail")) for r in toxicity._distinct(df).collect()]
    assert sorted(got) == sorted((toxic, text) for _, text, toxic in rows[:60])
    model = toxicity.fit(frame(spark, {i: t + " grumpf" * k for i, t, k in rows}), df.select("doc_id", "toxic"))
    assert model.grammar.words["grumpf"] > 1  # in every toxic text, in no clean one


def test_toxicity_filter_agrees_with_all_clauses():
    grammar = toxicity.Grammar(dict.fromkeys([*toxicity.INSULTS, "so", "гад"], 1.0), {"scum": 1.0, "идио": 1.0})
    words = ["idiot", "Idiot", "IDIOT", "connard", "scumbag", "so", "İdiot", "\u212aill", "ИдиоТ", "гад", "lamp", "not", "You", "will", "kill"]
    around = ["", " ", "¡", "¿", "“", "«\u00a0", "—", "…", "漢", "🙂", "\u200b", "_", "'", "1", "\u0301"]
    rnd = random.Random(6)
    texts = [f"{a}{w}{b}" for w in words for a in around for b in around] + ["", None]
    texts += ["".join(rnd.choice(around) + rnd.choice(words) + rnd.choice([" ", ". ", "; ", "”", "\n"]) for _ in range(30)) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    got = np.array([list(r.values()) for out in toxicity._features(grammar, [])([batch]) for r in out.to_pylist()])
    for text, row in zip(texts, got):
        scores = [x for c in toxicity._CLAUSE_END.split(text or "") if (x := toxicity.clause_score(c, grammar)) > 0]
        assert np.allclose(row[:3], [math.log1p(sum(scores)), min(max(scores, default=0), 8), math.log1p(len(scores))]), text


def toxicity_hashes(words):
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), ALNUM)
    return span_hashes(raw, starts, ends)


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (40, 20), (16_384, 512)])
def test_byte_bpe(spark, docs, chunk, overlap):
    rows = docs | {70: " \n\t b's  " * 90, 71: "word   " * 100 + "\t\t\n" * 200 + "zz"}
    enc = byte_bpe.encoding(RANKS, P.PATTERN)
    again = [(7, rows[7]), (70, rows[70]), (70, rows[70]), (71, rows[71]), (71, "other " * 300), (None, rows[71]), (None, rows[71]), (None, None)]
    every = [*rows.items(), *again]
    df = spark.createDataFrame([(i, t, "k", 1, "s", "c", "l") for i, t in every], SCHEMA)
    got = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN, chunk=chunk, overlap=overlap), RANKS).collect()
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in got) == Counter((i, t or "") for i, t in every)
    for r in got:
        text = bytes(r.decoded).decode()
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(text) and bytes(r.decoded).decode() == text


@pytest.mark.parametrize("length, gram", [(50, 24), (20, 10)])
def test_repeated_spans(spark, docs, monkeypatch, length, gram):
    monkeypatch.setattr(repeated_spans, "_PART", 2000)
    first = {}
    for i in sorted(docs):
        raw = (docs[i] or "").encode()
        for p in range(len(raw) - length + 1):
            first.setdefault(raw[p : p + length], i)
    for r in repeated_spans.remove_repeats(frame(spark, docs), length=length, gram=gram).collect():
        raw = (docs[r.doc_id] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < r.doc_id:
                gone[p : p + length] = b"\1" * length
        assert (r.n_removed, bytes(r.kept)) == (sum(gone), bytes(b for b, g in zip(raw, gone) if not g)), r.doc_id
    assert repeated_spans.remove_repeats(empty(spark)).count() == 0


def test_token_files(spark, docs, tmp_path):
    path = P.path("word_bpe_49k.json")
    specials = {200: "a <|endoftext|> b", 201: "x<|endoftext|>y <|startoftext|>", 202: "<|ENDOFTEXT|>", 203: "<|endoftext|><|endoftext|>\n<| endoftext |>"}
    docs = docs | specials
    files = token_files.write_tokens(frame(spark, docs), path, str(tmp_path / "tokens"), end_id=2, shard_bytes=3000, frame_bytes=500)
    assert files.count() > 1
    plain = Tokenizer.from_file(path)
    assert len(plain.encode("<|endoftext|>", add_special_tokens=False).ids) == 1
    got, start = {r.doc_id: r for r in token_files.read_tokens(files).collect()}, 0
    for i in sorted(docs):
        ids = plain.encode(docs[i] or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, np.frombuffer(got[i].ids, "<u4").tolist()) == (start, ids)
        start += len(ids)
    assert {r.doc_id for r in token_files.read_tokens(files, [5, 60]).collect()} == {5, 60}
    damaged = files.orderBy("shard").first()["path"].removeprefix("file:")
    raw = bytearray(open(damaged, "rb").read())
    raw[20] ^= 255
    open(damaged, "wb").write(raw)
    with pytest.raises(Exception):
        token_files.read_tokens(files).collect()
    assert token_files.read_tokens(token_files.write_tokens(empty(spark), path, str(tmp_path / "none"), end_id=2)).count() == 0


def test_context_tree(spark, docs):
    got = {r.doc_id: r for r in context_tree.score_texts(frame(spark, docs), page_bytes=4000, shard_bytes=4000, depth=3).collect()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    c = Counter(w for i in docs if not held[i] for w in words[i])
    total, distinct = sum(c.values()), len(c)
    # one node at a time, from counts of each context
    nodes = Counter()
    for i, t in docs.items():
        raw = b"\0\0\0" + (t or "").encode() + b"\0"
        for p in range(3, len(raw)) if not held[i] else ():
            for d in range(4):
                for k in range(8):
                    nodes[raw[p - d : p], 1 << k | raw[p] >> (8 - k), raw[p] >> (7 - k) & 1] += 1
    lg = math.lgamma

    def kt(a, b):
        return lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi)

    weigh = {}
    for context, node in sorted({x[:2] for x in nodes}, key=lambda x: -len(x[0])):
        own = kt(nodes[context, node, 0], nodes[context, node, 1])
        below = weigh.setdefault(("sum", context, node), 0.0)
        log_pw = own if len(context) == 3 else np.logaddexp(own, below) - math.log(2)
        weigh[context, node] = (1.0 if len(context) == 3 else 1 / (1 + math.exp(min(below - own, 700))),)
        if context:
            weigh["sum", context[1:], node] = weigh.get(("sum", context[1:], node), 0.0) + log_pw
    for i in (5, 8, 11, 0):
        raw, want = b"\0\0\0" + (docs[i] or "").encode() + b"\0", 0.0
        for p in range(3, len(raw)):
            for k in range(8):
                node, bit, prob = 1 << k | raw[p] >> (8 - k), raw[p] >> (7 - k) & 1, None
                for d in range(3, -1, -1):
                    context = raw[p - d : p]
                    if (context, node) in weigh:
                        a, b = nodes[context, node, 0], nodes[context, node, 1]
                        own = ((b if bit else a) + 0.5) / (a + b + 1)
                        w = weigh[context, node][0]
                        prob = own if prob is None else w * own + (1 - w) * prob
                want += math.log10(0.5 if prob is None else prob)
        assert math.isclose(got[i].score, want, rel_tol=1e-9)
    for i in docs:
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words[i])
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(words[i]), sum(c[w] > 0 for w in words[i]), total)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
    assert context_tree.score_texts(empty(spark)).count() == 0


def test_context_tree_deep(spark, docs, monkeypatch):
    """Seven bytes back: what six bytes can't tell apart is learned; groups of subtrees agree with one tree."""
    monkeypatch.setattr(context_tree, "GROUP_KEYS", 20)
    rnd = random.Random(9)
    pairs = [(a + "-same-" + b) for a, b in zip("abcd", "wxyz")]
    rows = {i: " ".join(rnd.choices(pairs, k=60)) for i in range(60)}
    deep, flat = ({r.doc_id: r for r in context_tree.score_texts(frame(spark, rows), page_bytes=4000, shard_bytes=4000, **how).collect()} for how in ({"depth": 7}, {"depth": 4}))
    held = [i for i in rows if deep[i].held_out]
    assert held and all(deep[i].score > 0.9 * flat[i].score for i in held)  # scores are negative
    number = lambda x, p: int.from_bytes(x[p : p + 7][::-1] + x[p + 7 : p + 8], "big")  # the nearest byte first
    train = [("\0" * 7 + t + "\0").encode() for i, t in rows.items() if not deep[i].held_out]
    strings = Counter(number(x, p) for x in train for p in range(len(x) - 7))
    codes = np.array(sorted(strings), np.uint64)
    levels = context_tree.build_levels(codes, np.array([strings[int(c)] for c in codes]), 7, 0)
    for i in held:
        x = ("\0" * 7 + rows[i] + "\0").encode()
        asked = np.array([number(x, p) for p in range(len(x) - 7)], np.uint64)
        assert math.isclose(deep[i].score, context_tree.byte_scores(asked, levels, 7).sum(), rel_tol=1e-9)


@pytest.mark.parametrize("depth", [5, 7])
def test_context_tree_equals_one_node_at_a_time(spark, docs, depth):
    """Counts of each context in plain dictionaries, at the depth that is run."""
    some = {i: docs[i] for i in (0, 1, 5, 7, 8, 9, 10, 11, 12, 13, 60)}
    got = {r.doc_id: r.score for r in context_tree.score_texts(frame(spark, some), depth=depth, page_bytes=500, shard_bytes=500).collect()}
    raw = {i: b"\0" * depth + (t or "").encode() + b"\0" for i, t in some.items()}
    nodes = Counter()
    for i, x in raw.items():
        for p in range(depth, len(x)) if zlib.crc32(str(i).encode()) % 5 != 1 else ():
            nodes.update((x[p - d : p], 1 << k | x[p] >> (8 - k), x[p] >> (7 - k) & 1) for d in range(depth + 1) for k in range(8))
    lg = math.lgamma
    below, weigh = Counter(), {}
    for context, node in sorted({n[:2] for n in nodes}, key=lambda n: -len(n[0])):
        a, b = nodes[context, node, 0], nodes[context, node, 1]
        own = lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi)
        last = len(context) == depth
        weigh[context, node] = (1.0 if last else 1 / (1 + math.exp(min(below[context, node] - own, 700))), (b + 0.5) / (a + b + 1))
        below[context[1:], node] += own if last else np.logaddexp(own, below[context, node]) - math.log(2)
    for i, x in raw.items():
        want = 0.0
        for p in range(depth, len(x)):
            for k in range(8):
                node, bit, prob = 1 << k | x[p] >> (8 - k), x[p] >> (7 - k) & 1, None
                for d in range(depth, -1, -1):
                    if (found := weigh.get((x[p - d : p], node))) is not None:
                        own = found[1] if bit else 1 - found[1]
                        prob = own if prob is None else found[0] * own + (1 - found[0]) * prob
                want += math.log10(0.5 if prob is None else prob)
        assert math.isclose(got[i], want, rel_tol=1e-9)


def test_kneser_ney(spark, docs):
    rnd = random.Random(8)
    rows = docs | {i: " ".join(rnd.choices(WORDS, k=40)) for i in range(100, 200)} | {i: "".join(rnd.choices("#%&*zqxj", k=200)) for i in range(300, 310)}
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100, 160)] + [(i, 0, 0) for i in range(300, 305)], "doc_id long, quality int, toxic int")
    df = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    got = {r.doc_id: r for r in kneser_ney.quality(df, labels, quantile=1.0).collect()}
    assert len(got) == len(rows) and all(got[i].kept for i in range(100, 160)) and not any(got[i].kept for i in range(300, 310))
    # the shards give what one table of all trusted texts gives, in one task a shard and in many
    strings = {i: [x[p : p + 5] for x in [bytes(4) + (t or "").encode() + bytes(1)] for p in range(len(x) - 4)] for i, t in rows.items()}
    whole = sorted((int.from_bytes(k, "big"), n) for k, n in Counter(k for i in range(100, 160) for k in strings[i]).items())
    tables = kneser_ney.build_tables(np.array([c for c, _ in whole], np.uint64), np.array([n for _, n in whole]), 5)
    want = {i: math.exp(-np.log(kneser_ney.probabilities(np.array([int.from_bytes(x, "big") for x in k], np.uint64), tables)).mean()) for i, k in strings.items()}
    model = kneser_ney.fit(df, labels.where("quality = 1").select("doc_id"), 5)
    split = {r.doc_id: r for r in kneser_ney.perplexities(df.withColumn("text", F.coalesce("text", F.lit(""))), model, 7, pages_per_task=2).collect()}
    for i in rows:
        assert math.isclose(got[i].perplexity, want[i], rel_tol=1e-9) and math.isclose(split[i].perplexity, want[i], rel_tol=1e-9)
    # all probabilities of a context sum to one
    counts = Counter(x[p : p + 3] for x in [rows[i].encode() for i in range(100, 130)] for p in range(len(x) - 2))
    codes = sorted((int.from_bytes(k, "big"), n) for k, n in counts.items())
    tables = kneser_ney.build_tables(np.array([c for c, _ in codes], np.uint64), np.array([n for _, n in codes]), 3)
    for context in (b"th", b"e ", b"~~"):
        strings = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert math.isclose(kneser_ney.probabilities(strings, tables).sum(), 1.0)
    assert kneser_ney.quality(empty(spark).withColumn("lang", F.lit("x")), labels).count() == 0
    assert kneser_ney.quality(df, labels.limit(0)).where("kept").count() == len(rows)
