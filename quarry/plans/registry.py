"""Query registry shared by ``__spark_entry__``, the tests and ``bench.py``."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = (
    "quarry.plans.retail_queries",
    "quarry.plans.dml_queries",
    "quarry.plans.text_queries",
    "quarry.plans.weak_queries",
    "quarry.plans.ml_queries",
    "quarry.plans.model_queries",
    "quarry.plans.run_queries",
    "quarry.plans.io_queries",
)


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its DuckDB oracle (if any)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for mod in _MODULES:
        importlib.import_module(mod)
