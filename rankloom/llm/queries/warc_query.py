"""All pages written to web archives and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.llm.warc import page_of, read_warc, write_warc


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_warc(write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), min_bytes=0))
    return found.where(F.col("record_type").isin("response", "revisit")).select(
        page_of(F.col("record_id")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", page_of(F.col("refers_to")).cast("long")).alias("refers_to"),
    )


# five hexadecimal digits are four of base 32
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)), '')"""

_OP13 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
r AS (SELECT page_id, octet_length(encode(body)) AS n, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS top,
  row_number() OVER (PARTITION BY body ORDER BY page_id DESC) AS k FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to FROM r
"""

QUERIES = {"op13_warc": op13_warc}
ORACLE = {"op13_warc": _OP13}
