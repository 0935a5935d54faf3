"""Query registry: each query is a Spark function plus its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco
