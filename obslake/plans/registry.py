"""Registered queries: a Spark callable each, and the same question in SQL where SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.landed import Tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = name
        _QUERIES[name] = run
        if sql:
            _SQL[name] = sql.strip()
        return fn

    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)
