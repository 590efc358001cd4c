"""Names of queries, each with its DataFrame and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` is DuckDB SQL with the same rows."""

    def register(run: Query) -> Query:
        if run.__name__ in QUERIES:
            raise ValueError(f"query {run.__name__} exists")
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register
