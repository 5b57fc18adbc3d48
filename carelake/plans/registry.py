"""Registry of named queries: Spark callable + DuckDB oracle text.

Each plan module registers ``name -> fn(spark, sf_dir) -> DataFrame`` and,
where the result is expressible in plain SQL over the driver tables, the
equivalent DuckDB SQL with the same column names.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from . import (audits, dashboard, evaluation, functions, measures, partials,  # noqa: F401
                   predicates, responses, tables)
