"""All registered queries and their oracles."""

from __future__ import annotations

import importlib

MODULES = (
    "source_queries",
    "text_queries",
    "sampling_queries",
    "join_queries",
    "lexical_queries",
    "index_queries",
    "dense_queries",
    "fusion_queries",
    "rerank_queries",
    "classify_queries",
    "metric_queries",
    "profile_queries",
    "output_queries",
)


def _collect(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        merged.update(getattr(importlib.import_module(f"rankloom.catalog.{name}"), attribute))
    return merged


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
