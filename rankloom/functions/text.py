"""Text columns: cleaning, content building, tokenising.

Everything here is a plain Column expression, so it runs inside the scan stage
and needs neither a shuffle nor a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values -----------------------------------------------------------
REPLACEMENT_CHAR = "�"
TECH_TOKEN_PATTERN = r"(?:\.[a-z0-9]+|[a-z0-9]+(?:[._-][a-z0-9]+)*(?:\+\+|#)?)"
SIMPLE_TOKEN_PATTERN = r"(?<![\p{L}\p{N}_])[a-z0-9]+(?![\p{L}\p{N}_])"
WORD_TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
PUNCTUATION_RUN_PATTERN = r"([!?.]){2,}"
SPACE_CLASS = r"[\s\x1c-\x1f]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
UNKNOWN_CATEGORY = "unknown"
# ----------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c: Column | str) -> Column:
    """Remove Unicode white space at both ends; only the ends are looked at."""
    return F.btrim(_col(c), F.lit(SPACE_CHARS))


def null_to_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def safe_text(c: Column | str, replace_bad_chars: bool = True) -> Column:
    """Null-safe, stripped string; U+FFFD becomes a space unless switched off."""
    text = null_to_empty(c)
    if replace_bad_chars:
        text = F.replace(text, F.lit(REPLACEMENT_CHAR), F.lit(" "))
    return strip_space(text)


def tag_text(tags: Column | str) -> Column:
    """Cleaned tags joined by a space; null when nothing is left."""
    cleaned = F.transform(_col(tags), lambda t: safe_text(t))
    return F.nullif(F.array_join(F.filter(cleaned, lambda t: t != ""), " "), F.lit(""))


def build_content(
    title: Column | str, text: Column | str, tags: Column | str | None = None, tags_are_text: bool = False
) -> Column:
    """Title, text and tags joined by a space, empty parts left out."""
    parts = [F.nullif(safe_text(title), F.lit("")), F.nullif(safe_text(text), F.lit(""))]
    if tags is not None:
        parts.append(F.nullif(safe_text(tags), F.lit("")) if tags_are_text else tag_text(tags))
    return F.concat_ws(" ", *parts)


def clean_text(c: Column | str) -> Column:
    """Lower case, single spaces, punctuation runs cut to their last character."""
    spaced = F.regexp_replace(F.lower(_col(c)), rf"(?U){SPACE_CLASS}+", " ")
    return strip_space(F.regexp_replace(spaced, PUNCTUATION_RUN_PATTERN, "$1"))


def with_content(df: DataFrame, clean: bool = False, tags: str | None = "tags") -> DataFrame:
    """Add the ``content`` column to documents or queries."""
    content = build_content("title", "text", tags)
    return df.withColumn("content", clean_text(content) if clean else content)


def truncate_text(c: Column | str, max_chars: int | None) -> Column:
    """First ``max_chars`` characters; ``None`` leaves the text alone."""
    if max_chars is None:
        return _col(c)
    if max_chars <= 0:
        raise ValueError(f"a text can't be cut to {max_chars} characters")
    return F.substring(null_to_empty(c), 1, max_chars)


def tech_tokens(c: Column | str) -> Column:
    """Tokens that keep ``c++``, ``c#``, ``.net`` and ``node.js`` whole."""
    return F.regexp_extract_all(F.lower(null_to_empty(c)), F.lit(TECH_TOKEN_PATTERN), F.lit(0))


def simple_tokens(c: Column | str) -> Column:
    """ASCII words that touch no other word character."""
    return F.regexp_extract_all(F.lower(null_to_empty(c)), F.lit(SIMPLE_TOKEN_PATTERN), F.lit(0))


def word_tokens(c: Column | str) -> Column:
    """Unicode words of two or more characters (the vectoriser tokens)."""
    return F.regexp_extract_all(F.lower(null_to_empty(c)), F.lit(WORD_TOKEN_PATTERN), F.lit(0))


TOKENIZERS = {"tech": tech_tokens, "simple": simple_tokens, "word": word_tokens}


def tokenizer(name: str):
    if name not in TOKENIZERS:
        raise ValueError(f"tokenizer must be one of {sorted(TOKENIZERS)}, not {name!r}")
    return TOKENIZERS[name]


def ngrams(tokens: Column | str, low: int = 1, high: int = 2) -> Column:
    """All word n-grams with ``low <= n <= high``, space-joined."""
    if not 1 <= low <= high <= 2:
        raise ValueError("n-grams of one and two words are supported")
    t = _col(tokens)
    parts = []
    if low == 1:
        parts.append(t)
    if high == 2:
        shorter = F.greatest(F.size(t) - 1, F.lit(0))
        heads, tails = F.slice(t, F.lit(1), shorter), F.slice(t, F.lit(2), shorter)
        parts.append(F.zip_with(heads, tails, lambda a, b: F.concat_ws(" ", a, b)))
    return F.concat(*parts)


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words."""
    stripped = strip_space(null_to_empty(c))
    return F.when(stripped == "", F.lit(0)).otherwise(F.size(F.split(stripped, rf"(?U){SPACE_CLASS}+")))


def default_category(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(UNKNOWN_CATEGORY))


def id_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def model_label(model: Column | str, embedding_model: Column | str, bm25_method: Column | str) -> Column:
    """``embeddings:<name>``, ``bm25:<variant>`` or the bare model name."""
    m = _col(model)
    return (
        F.when(m == "embeddings", F.concat_ws(":", m, _col(embedding_model)))
        .when(m == "bm25", F.concat_ws(":", m, _col(bm25_method)))
        .otherwise(m)
    )


def ids_to_json(ids: Column | str) -> Column:
    return F.to_json(_col(ids))


def json_to_ids(text: Column | str) -> Column:
    return F.from_json(_col(text), "array<string>")
