"""How plans register queries: a function of (session, folder), and the SQL it is held against, if SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table

Query = Callable[[SparkSession, str], DataFrame]


class Plans:
    """The queries of one module."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(run: Query) -> Query:
            self.queries[run.__name__] = run
            if sql:
                self.sql[run.__name__] = sql
            return run

        return register


__all__ = ["DataFrame", "Plans", "Query", "SparkSession", "table"]
