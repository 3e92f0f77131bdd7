"""SQL pieces for the oracles: plain tables in, common table expressions out.

They restate each definition the direct way (every query against every document),
so they share no shortcut with the Spark operators.
"""

from __future__ import annotations

SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TECH = r"(?:\.[a-z0-9]+|[a-z0-9]+(?:[._-][a-z0-9]+)*(?:\+\+|#)?)"
WORD = r"[\p{L}\p{N}_]{2,}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACES}+|{SPACES}+$', '', 'g')"


def safe(x: str) -> str:
    return strip(f"replace(coalesce({x}, ''), chr(65533), ' ')")


def tech(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TECH}')"


def word(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}')"


def word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{SPACES[1:-1]}]+'))"


RAW = """d0 AS (
  SELECT doc_id, lang, source, split_part(text, chr(10), 1) AS title,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS body
  FROM documents)"""

DOCS = f"""{RAW},
docs AS (
  SELECT doc_id, title, body, lang AS category, source,
         concat_ws(' ', nullif({safe('title')}, ''), nullif({safe('body')}, ''), lang || ' ' || source) AS content
  FROM d0)"""

BENCH = "bq AS (SELECT item_id AS qid, text AS content FROM benchmark)"
BENCH_QRELS = """bqr AS (SELECT b.item_id AS qid, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""

TITLES = """tq AS (
  SELECT min(doc_id) AS qid, title AS content, arg_min(lang, doc_id) AS category
  FROM d0 GROUP BY title HAVING count(*) > 1)"""
TITLE_QRELS = "tqr AS (SELECT tq.qid, d0.doc_id FROM d0 JOIN tq ON d0.title = tq.content)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def bm25(name: str, queries: str, k: str, method: str = "plus", docs: str = "docs") -> str:
    """Run ``name(qid, doc_id, score, rank)``."""
    raw = "ln(n - df + 0.5) - ln(df + 0.5)"
    if method == "plus":
        idf = f"{name}_i AS (SELECT term, ln((n + 1.0) / df) AS idf FROM {name}_df, {name}_c)"
        base = f"{name}_b AS (SELECT qid, sum(qtf * idf) AS base FROM {name}_q JOIN {name}_i USING (term) GROUP BY qid)"
    else:
        idf = f"""{name}_r AS (SELECT term, {raw} AS r FROM {name}_df, {name}_c),
{name}_i AS (SELECT term, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM {name}_r) ELSE r END AS idf FROM {name}_r)"""
        base = f"{name}_b AS (SELECT DISTINCT qid, 0.0 AS base FROM {name}_q)"
    return f"""{name}_t AS (SELECT doc_id, {tech('content')} AS ts FROM {docs}),
{name}_l AS (SELECT doc_id, len(ts) AS dl FROM {name}_t),
{name}_c AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM {name}_l),
{name}_p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM {name}_t) GROUP BY ALL),
{name}_df AS (SELECT term, count(*) AS df FROM {name}_p GROUP BY term),
{idf},
{name}_q AS (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({tech('content')}) AS term FROM {queries}) GROUP BY ALL),
{base},
{name}_s AS (
  SELECT qid, doc_id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS s
  FROM {name}_q JOIN {name}_p USING (term) JOIN {name}_i USING (term) JOIN {name}_l USING (doc_id), {name}_c
  GROUP BY ALL),
{name} AS (
  SELECT qid, doc_id, score, rank FROM (
    SELECT q.qid, d.doc_id, coalesce(s, 0) + coalesce(base, 0) AS score,
           row_number() OVER (PARTITION BY q.qid ORDER BY coalesce(round(s, 9), 0) DESC, d.doc_id) AS rank
    FROM {queries} q CROSS JOIN {docs} d
    LEFT JOIN {name}_s s ON s.qid = q.qid AND s.doc_id = d.doc_id LEFT JOIN {name}_b b ON b.qid = q.qid)
  WHERE rank <= {k})"""


def tfidf(name: str, queries: str, k: str, docs: str = "docs") -> str:
    return f"""{name}_p AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({word('content')}) AS term FROM {docs}) GROUP BY ALL),
{name}_i AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM {docs})) / (1.0 + count(*))) + 1 AS idf FROM {name}_p GROUP BY term),
{name}_w AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM {name}_p JOIN {name}_i USING (term)),
{name}_n AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM {name}_w GROUP BY doc_id),
{name}_q AS (
  SELECT qid, term, (1 + ln(qtf)) * idf AS w
  FROM (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({word('content')}) AS term FROM {queries}) GROUP BY ALL)
  JOIN {name}_i USING (term)),
{name}_qn AS (SELECT qid, sqrt(sum(w * w)) AS n FROM {name}_q GROUP BY qid),
{name}_s AS (
  SELECT q.qid, w.doc_id, sum(q.w * w.w) / any_value(qn.n) / any_value(n.n) AS s
  FROM {name}_q q JOIN {name}_w w USING (term) JOIN {name}_qn qn ON qn.qid = q.qid JOIN {name}_n n ON n.doc_id = w.doc_id
  GROUP BY ALL),
{name} AS (
  SELECT qid, doc_id, score, rank FROM (
    SELECT q.qid, d.doc_id, coalesce(s, 0) AS score,
           row_number() OVER (PARTITION BY q.qid ORDER BY coalesce(round(s, 9), 0) DESC, d.doc_id) AS rank
    FROM {queries} q CROSS JOIN {docs} d LEFT JOIN {name}_s s ON s.qid = q.qid AND s.doc_id = d.doc_id)
  WHERE rank <= {k})"""


def hashed(name: str, source: str, key: str, dim: int = 64) -> str:
    """Long vectors ``name(key, i, v)`` of the hash encoder, unit length, non-zero entries only."""
    return f"""{name}_h AS (SELECT {key}, md5(unnest({tech('content')})) AS h FROM {source}),
{name}_v AS (
  SELECT {key}, ('0x' || substr(h, 1, 4))::INTEGER % {dim} AS i,
         sum(CASE WHEN substr(h, 5, 1) < '8' THEN 1.0 ELSE -1.0 END) AS v
  FROM {name}_h GROUP BY ALL),
{name} AS (
  SELECT {key}, i, v / greatest(sqrt(sum(v * v) OVER (PARTITION BY {key})), 1e-12) AS v FROM {name}_v)"""


def knn(name: str, qv: str, dv: str, queries: str, k: str, docs: str = "docs") -> str:
    """Run over unit long vectors; pairs without a common entry score 0."""
    return f"""{name}_s AS (SELECT qid, doc_id, sum(q.v * d.v) AS s FROM {qv} q JOIN {dv} d USING (i) GROUP BY ALL),
{name} AS (
  SELECT qid, doc_id, score, rank FROM (
    SELECT q.qid, d.doc_id, coalesce(s, 0) AS score,
           row_number() OVER (PARTITION BY q.qid ORDER BY coalesce(round(s, 9), 0) DESC, d.doc_id) AS rank
    FROM {queries} q CROSS JOIN {docs} d LEFT JOIN {name}_s s ON s.qid = q.qid AND s.doc_id = d.doc_id)
  WHERE rank <= {k})"""


def dense(name: str, queries: str, k: str, docs: str = "docs", dim: int = 64) -> str:
    """Hash-encode both sides and rank."""
    return ",\n".join(
        [hashed(f"{name}_dv", docs, "doc_id", dim), hashed(f"{name}_qv", queries, "qid", dim),
         knn(name, f"{name}_qv", f"{name}_dv", queries, k, docs)]
    )


def fuse(name: str, runs: list[tuple[str, float]], rrf_k: int, k: str) -> str:
    """Weighted fusion of runs in order; ties keep source order, then rank."""
    parts = " UNION ALL ".join(
        f"SELECT qid, doc_id, {w} / ({rrf_k} + rank) AS part, {i} AS ord, rank FROM {run}" for i, (run, w) in enumerate(runs)
    )
    return f"""{name}_u AS ({parts}),
{name}_f AS (SELECT qid, doc_id, sum(part) AS score, min(ord * 1000000 + rank) AS seen FROM {name}_u GROUP BY ALL),
{name} AS (
  SELECT * FROM (
    SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, seen) AS rank FROM {name}_f)
  WHERE rank <= {k})"""


def run_out(name: str) -> str:
    return f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM {name}"


def grams(name: str, source: str, key: str, text: str) -> str:
    """Unigram and bigram counts ``name(key, term, tf)``."""
    return f"""{name}_w AS (
  SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM (SELECT {key}, {word(text)} AS ws FROM {source})),
{name}_g AS (
  SELECT {key}, w AS term FROM {name}_w
  UNION ALL
  SELECT {key}, term FROM (SELECT {key}, w || ' ' || lead(w) OVER (PARTITION BY {key} ORDER BY p) AS term FROM {name}_w)
  WHERE term IS NOT NULL),
{name} AS (SELECT {key}, term, count(*) AS tf FROM {name}_g GROUP BY ALL)"""


def vocabulary(name: str, counts: str, size: int | None = None) -> str:
    """All terms, or the ``size`` most frequent."""
    cut = "" if size is None else f" ORDER BY cf DESC, term LIMIT {size}"
    return f"""{name} AS (
  SELECT term, cf, df, row_number() OVER (ORDER BY term) - 1 AS idx
  FROM (SELECT term, sum(tf) AS cf, count(*) AS df FROM {counts} GROUP BY term{cut}))"""


def tfidf_weights(name: str, counts: str, vocab: str, train: str, key: str) -> str:
    return f"""{name}_r AS (
  SELECT {key}, term, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM {train})) / (1.0 + df)) + 1) AS w
  FROM {counts} JOIN {vocab} USING (term)),
{name} AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM {name}_r)"""


def naive_bayes(name: str, train: str, target: str, key: str = "row_id", size: int | None = None) -> str:
    """TF-IDF Naive Bayes: ``name(key, category, jll)``, ``name_p(key, category, p)``, ``name_y(key, prediction)``.

    ``train(row_id, text, label)``, ``target(row_id, text)``.
    """
    return ",\n".join([
        grams(f"{name}_tg", train, key, "text"),
        grams(f"{name}_sg", target, key, "text"),
        vocabulary(f"{name}_v", f"{name}_tg", size),
        tfidf_weights(f"{name}_tw", f"{name}_tg", f"{name}_v", train, key),
        tfidf_weights(f"{name}_sw", f"{name}_sg", f"{name}_v", train, key),
        f"""{name}_pr AS (SELECT label AS category, ln(count(*) * 1.0 / (SELECT count(*) FROM {train})) AS lp FROM {train} GROUP BY label),
{name}_m AS (SELECT label AS category, term, sum(weight) AS m FROM {name}_tw JOIN {train} USING ({key}) GROUP BY ALL),
{name}_g AS (SELECT c.category, v.term, coalesce(m, 0) + 1 AS m FROM {name}_pr c CROSS JOIN {name}_v v LEFT JOIN {name}_m x ON x.category = c.category AND x.term = v.term),
{name}_l AS (SELECT category, term, ln(m / sum(m) OVER (PARTITION BY category)) AS logp FROM {name}_g),
{name}_s AS (SELECT {key}, category, sum(weight * logp) AS s FROM {name}_sw JOIN {name}_l USING (term) GROUP BY ALL),
{name} AS (
  SELECT t.{key}, c.category, c.lp + coalesce(s.s, 0) AS jll
  FROM {target} t CROSS JOIN {name}_pr c LEFT JOIN {name}_s s ON s.{key} = t.{key} AND s.category = c.category),
{name}_e AS (SELECT {key}, category, exp(jll - max(jll) OVER (PARTITION BY {key})) AS e FROM {name}),
{name}_p AS (SELECT {key}, category, e / sum(e) OVER (PARTITION BY {key}) AS p FROM {name}_e),
{name}_y AS (SELECT {key}, category AS prediction FROM (
  SELECT {key}, category, row_number() OVER (PARTITION BY {key} ORDER BY round(jll, 9) DESC, category) AS r FROM {name}) WHERE r = 1)""",
    ])


def metrics(run: str, qrels: str, queries: str, ks: tuple[int, ...], group: str = "", group_sizes: str | None = None) -> str:
    """SELECT of rounded mean precision, recall, MRR per (group, k) over all queries."""
    g = f"{group}, " if group else ""
    groups = f"(SELECT DISTINCT {group} FROM {run})" if group else "(SELECT 1 AS one)"
    per = " AND ".join(f"r.{c.strip()} = g.{c.strip()}" for c in group.split(",")) if group else "true"
    gcols = ", ".join(f"g.{c.strip()}" for c in group.split(",")) + ", " if group else ""
    same = group_sizes or "true"
    ks_sql = ", ".join(str(k) for k in ks)
    return f"""SELECT {gcols}CAST(k AS INTEGER) AS k,
  round(avg(p), 6) AS precision, round(avg(rc), 6) AS recall, round(avg(rr), 6) AS mrr FROM (
  SELECT {gcols}k.k, q.qid,
    (SELECT count(DISTINCT r.doc_id) FROM {run} r JOIN {qrels} x ON x.qid = r.qid AND x.doc_id = r.doc_id
      WHERE r.qid = q.qid AND r.rank <= k.k AND {per}) * 1.0 / k.k AS p,
    coalesce((SELECT count(DISTINCT r.doc_id) FROM {run} r JOIN {qrels} x ON x.qid = r.qid AND x.doc_id = r.doc_id
      WHERE r.qid = q.qid AND r.rank <= k.k AND {per}) * 1.0
      / nullif((SELECT count(DISTINCT x.doc_id) FROM {qrels} x WHERE x.qid = q.qid), 0), 0) AS rc,
    coalesce(1.0 / (SELECT min(r.rank) FROM {run} r JOIN {qrels} x ON x.qid = r.qid AND x.doc_id = r.doc_id
      WHERE r.qid = q.qid AND r.rank <= k.k AND {per}), 0) AS rr
  FROM {queries} q CROSS JOIN {groups} g CROSS JOIN (SELECT unnest([{ks_sql}]) AS k) k WHERE {same}) g
GROUP BY {gcols}k"""
