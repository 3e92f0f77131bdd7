"""Tokenisers and cleaning on hand-checked strings."""

import pytest
from pyspark.sql import functions as F

from rankloom.functions import text as tx


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("o")).first()["o"]


def test_tech_tokens(spark):
    got = one(spark, tx.tech_tokens, "Use C++ and C#, .NET 4.5 node.js a_b x-y foo... wat?!")
    assert got == ["use", "c++", "and", "c#", ".net", "4.5", "node.js", "a_b", "x-y", "foo", "wat"]


def test_simple_tokens_skip_accented_words(spark):
    assert one(spark, tx.simple_tokens, "été plain café A1") == ["plain", "a1"]


def test_clean_text(spark):
    assert one(spark, tx.clean_text, "ok... wat?! ") == "ok. wat!"


def test_safe_text(spark):
    assert one(spark, tx.safe_text, "  a�b \t") == "a b"
    assert one(spark, tx.safe_text, None) == ""


def test_word_count_and_empty(spark):
    assert one(spark, tx.word_count, " a  b c ") == 3
    assert one(spark, tx.word_count, "  ") == 0


def test_build_content_skips_empty_parts(spark):
    rows = spark.createDataFrame(
        [(None, "body", [" x ", None, ""]), ("t", None, None), ("�", " ", ["y", "z"])], "title string, text string, tags array<string>"
    )
    got = [r[0] for r in rows.select(tx.build_content("title", "text", "tags")).collect()]
    assert got == ["body x", "t", "y z"]


def test_ngrams_of_short_lists(spark):
    rows = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "t array<string>")
    assert [r[0] for r in rows.select(tx.ngrams("t")).collect()] == [[], ["a"], ["a", "b", "c", "a b", "b c"]]


def test_truncate_rejects_bad_limit():
    with pytest.raises(ValueError):
        tx.truncate_text("c", 0)


def test_unknown_tokenizer():
    with pytest.raises(ValueError):
        tx.tokenizer("none")
