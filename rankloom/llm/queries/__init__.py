"""Queries of the operators, with SQL where it can express them."""

from __future__ import annotations

import importlib

MODULES = (
    "decontaminate_query",
    "pii_query",
    "jaccard_join_query",
    "kneser_ney_query",
    "product_quantiser_query",
    "toxicity_query",
    "byte_bpe_query",
    "repeated_spans_query",
    "token_files_query",
    "context_tree_query",
    "conversation_repair_query",
    "whitening_query",
    "warc_query",
)


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(importlib.import_module(f"{__name__}.{name}"), attribute))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE")
