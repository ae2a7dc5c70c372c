"""Registered queries: a Spark callable and, where SQL can say it, the DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Register the decorated query under ``name``."""

        def keep(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query registered twice: {name}")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return keep
