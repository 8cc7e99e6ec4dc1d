"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dqlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf: fn(configure(spark), sf)
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add
