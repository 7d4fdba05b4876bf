"""The registry of queries: every module of ``inkwell.queries`` adds its own when imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator: register a query under ``name`` with its SQL oracle, if SQL can express it."""

    def add(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries are named {name}")
        _QUERIES[name] = query
        if sql is not None:
            _ORACLES[name] = sql
        return query

    return add


def queries() -> dict[str, Query]:
    return _QUERIES


def oracles() -> dict[str, str]:
    return _ORACLES

