"""Registered queries and their SQL counterparts, by subject."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a function under its own name, with the SQL text that gives the same rows."""

        def register(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.oracles[function.__name__] = sql
            return function

        return register
