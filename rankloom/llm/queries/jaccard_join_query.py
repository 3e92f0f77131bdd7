"""Near copies among all documents: 3-word shingles, Jaccard similarity of 0.9 or more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.jaccard_join import jaccard_components, jaccard_links


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90)


def op3_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90)


_OP3 = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 2), ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
r AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY x, y),
l AS MATERIALIZED (SELECT x, y FROM r JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS top FROM d UNION SELECT e.y, reach.top FROM reach JOIN e ON e.x = reach.doc_id WHERE reach.top < e.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, t.top AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(top) AS top FROM reach GROUP BY doc_id) t ON t.doc_id = d.doc_id
"""

# the same, with the number of links of each document
_OP3_LINKS = _OP3.replace("AS component_id\n", "AS component_id,\n  CAST((SELECT count(*) FROM e WHERE e.x = d.doc_id) AS BIGINT) AS n_links\n")

QUERIES = {"op3_jaccard_join": op3_jaccard_join, "op3_jaccard_links": op3_jaccard_links}
ORACLE = {"op3_jaccard_join": _OP3, "op3_jaccard_links": _OP3_LINKS}
