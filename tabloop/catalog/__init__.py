"""Registered queries over the given tables, each with an equivalent SQL text where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` gives the same result on the same tables."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def load_all() -> None:
    from tabloop.catalog import drift, models, prepare, recipes, requests, resample, scored  # noqa: F401
