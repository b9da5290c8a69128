"""Named-query registry: each entry is a Spark plan over the base tables and,
where SQL can express it, the DuckDB oracle that checks its values."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    section: str


QUERIES: dict[str, Query] = {}


def register(name: str, section: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, section)
        return fn
    return deco
