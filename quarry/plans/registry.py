"""Named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame``; ``sql`` (optional) is an
ANSI query over the fixture tables that must return the same rows with the
same column names.  Queries without SQL are checked rows-only (random or
iterative models).
"""
from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
NOTES: dict[str, str] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        if note:
            NOTES[name] = note
        return fn
    return deco


def with_(*ctes: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix from CTE fragments."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
