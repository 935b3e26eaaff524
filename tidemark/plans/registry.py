"""The registered queries: a Spark callable and the equal SQL, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``covers`` names inventory lines it exercises."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(fn, sql, tuple(covers.split()))
        return fn
    return add
