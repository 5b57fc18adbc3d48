"""Queries of the subpackage: name -> callable, and DuckDB SQL where it can say it."""
from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco
