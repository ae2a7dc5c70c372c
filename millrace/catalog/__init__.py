"""The registered queries by family."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("corpus_queries", "runlog_queries", "array_queries", "annotation_queries", "manifest_queries",
            "temporal_queries", "stream_queries")


def _registries():
    return [import_module(f"{__name__}.{family}").registry for family in FAMILIES]


def all_queries():
    return {name: query for r in _registries() for name, query in r.queries.items()}


def all_sql():
    return {name: sql for r in _registries() for name, sql in r.sql.items()}
