"""JSON and Parquet readers for documents, queries and judgments."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rankloom.functions.text import truncate_text, with_content
from rankloom.operators.sampling import head
from rankloom.sources.json_array import read_json_array

# --- fixed values -----------------------------------------------------------
DOCS_FILE = "docs.json"
TRAIN_FILE = "queries_train.json"
TEST_FILE = "queries_test.json"
QRELS_FILE = "qgts_train.json"
RELEVANT_KEYS = ("relevant_doc_ids", "doc_ids", "relevant")
QUERY_KEYS = ("query_id", "qid", "id")
ENTRY_KEYS = ("doc_id", "id", "docid")
# ----------------------------------------------------------------------------

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("tags", T.VariantType()),
        T.StructField("category", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)


def _tag_array(tags: Column) -> Column:
    """A tag list, or a bare tag string as a list of one."""
    as_list = F.try_variant_get(tags, "$", "array<string>")
    as_text = F.try_variant_get(tags, "$", "string")
    is_list = F.startswith(F.schema_of_variant(tags), F.lit("ARRAY"))
    return F.when(is_list, as_list).when(as_text.isNotNull(), F.array(as_text))


def parse_records(df: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """Rows of ``RECORD_SCHEMA`` with the id renamed and tags as a string array."""
    return df.select(F.col("id").alias(id_name), "title", "text", _tag_array(F.col("tags")).alias("tags"), "category", "content")


def read_records(
    spark: SparkSession, path: str, id_name: str = "doc_id", multi_line: bool = True, range_bytes: int | None = None
) -> DataFrame:
    """JSON array files (or JSON lines with ``multi_line=False``, which split across tasks).

    With ``range_bytes`` an array file is read by as many tasks as it has ranges of that size.
    """
    if range_bytes is not None:
        return parse_records(read_json_array(spark, path, RECORD_SCHEMA, range_bytes), id_name)
    return parse_records(spark.read.schema(RECORD_SCHEMA).json(path, multiLine=multi_line), id_name)


def read_all(spark: SparkSession, folder: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents, train queries, test queries and judgments of one folder."""
    return (
        read_records(spark, os.path.join(folder, DOCS_FILE), "doc_id", multi_line),
        read_records(spark, os.path.join(folder, TRAIN_FILE), "qid", multi_line),
        read_records(spark, os.path.join(folder, TEST_FILE), "qid", multi_line),
        read_judgments(spark, os.path.join(folder, QRELS_FILE)),
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_search_inputs(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str | None = None,
    *,
    use_processed: bool = True,
    clean: bool = False,
    max_docs: int | None = None,
    doc_chars: int | None = None,
    query_chars: int | None = None,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Documents and test queries with ``content``: the prepared tables if they exist, else the raw files."""
    ready = None
    if use_processed and processed_dir:
        ready = [os.path.join(processed_dir, n) for n in ("docs", "queries_test")]
        if not all(_exists(spark, p) for p in ready):
            ready = None
    if ready:
        docs, queries = (spark.read.parquet(p) for p in ready)
    else:
        docs = with_content(read_records(spark, os.path.join(raw_dir, DOCS_FILE), "doc_id", multi_line), clean)
        queries = with_content(read_records(spark, os.path.join(raw_dir, TEST_FILE), "qid", multi_line), clean)
    docs = head(docs, max_docs)
    return (
        docs.withColumn("content", truncate_text("content", doc_chars)),
        queries.withColumn("content", truncate_text("content", query_chars)),
    )


def _present(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def _kind(v: Column) -> Column:
    return F.substring_index(F.schema_of_variant(v), "<", 1)


def _entries(v: Column) -> Column:
    """Judgment entries as an array of variants; a scalar is a list of one, JSON null is none."""
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.array().cast("array<variant>"))
        .when(_kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<variant>"))
        .otherwise(F.array(v))
    )


def _first_key(v: Column, keys: tuple[str, ...]) -> Column:
    """Value of the first key that is present, as a variant."""
    return F.coalesce(*[_present(v, k) for k in keys])


def _entry_id(entry: Column) -> Column:
    """Document id of one entry: itself, or the first id key of an object."""
    value = F.when(_kind(entry) == "OBJECT", _first_key(entry, ENTRY_KEYS)).otherwise(entry)
    return F.when(value.isNotNull() & ~F.is_variant_null(value), F.try_variant_get(value, "$", "string"))


def parse_judgments(files: DataFrame) -> DataFrame:
    """``(qid, entries, category, total_relevant_docs)`` from JSON texts in ``value``.

    A text is an object keyed by query, or a list of row objects. Any other JSON
    makes the job fail; list rows without a query id are left out.
    """
    v = files.select(F.parse_json("value").alias("v")).withColumn("kind", _kind(F.col("v")))
    keyed = F.transform_keys(
        F.coalesce(F.try_variant_get("v", "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")),
        lambda k, _: k,
    )
    listed = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array().cast("array<variant>"))
    row_type = "struct<qid:string,body:variant>"
    as_rows = (
        F.when(
            F.col("kind") == "OBJECT",
            F.transform(F.map_entries(keyed), lambda e: F.struct(e["key"].alias("qid"), e["value"].alias("body"))),
        )
        .when(
            F.col("kind") == "ARRAY",
            F.transform(
                F.filter(listed, lambda r: _kind(r) == "OBJECT"),
                lambda r: F.struct(
                    F.try_variant_get(_first_key(r, QUERY_KEYS), "$", "string").alias("qid"), r.alias("body")
                ),
            ),
        )
        .otherwise(F.raise_error(F.lit("unsupported judgment format")).cast(f"array<{row_type}>"))
    )
    rows = v.select(F.explode(as_rows).alias("r")).select("r.qid", "r.body").where(F.col("qid").isNotNull())
    is_object = _kind(F.col("body")) == "OBJECT"
    relevant = F.when(is_object, _first_key(F.col("body"), RELEVANT_KEYS)).otherwise(F.col("body"))
    return rows.select(
        "qid",
        _entries(relevant).alias("entries"),
        F.when(is_object, F.try_variant_get("body", "$.category", "string")).alias("category"),
        F.when(is_object, F.coalesce(F.try_variant_get("body", "$.total_relevant_docs", "int"), F.lit(0)))
        .otherwise(F.size(_entries(relevant)))
        .alias("total_relevant_docs"),
    )


def read_judgments(spark: SparkSession, path: str, whole_text: bool = True) -> DataFrame:
    """Judgment files; with ``whole_text=False`` every line is a JSON text of its own."""
    return parse_judgments(spark.read.text(path, wholetext=whole_text))


def judgment_pairs(judgments: DataFrame) -> DataFrame:
    """Distinct ``(qid, doc_id)``; null entries fall out."""
    pairs = judgments.select("qid", F.explode("entries").alias("e")).select("qid", _entry_id(F.col("e")).alias("doc_id"))
    return pairs.where(F.col("doc_id").isNotNull()).dropDuplicates(["qid", "doc_id"])


def judged_queries(judgments: DataFrame) -> DataFrame:
    """Every query that has a judgment, the empty ones included."""
    return judgments.select("qid").distinct()


def judgment_categories(judgments: DataFrame) -> DataFrame:
    """``(qid, category)``; a missing category is an error."""
    missing = F.raise_error(F.concat(F.lit("no category for query "), F.col("qid")))
    return judgments.select("qid", F.when(F.col("category").isNull(), missing).otherwise(F.col("category")).alias("category"))
