"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` plus
the DuckDB SQL that must return the same rows (absent for model queries,
which are checked by rows only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from keysieve.plans import (  # noqa: F401
        q_breach, q_corpus, q_features, q_io, q_metrics, q_models, q_profile, q_sampling,
        q_summaries)
