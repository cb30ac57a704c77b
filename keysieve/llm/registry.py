"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from keysieve.llm.common import with_package

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = wraps(fn)(lambda spark, sf_dir: fn(with_package(spark), sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def load_all() -> None:
    from keysieve.llm import queries  # noqa: F401
