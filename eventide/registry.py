"""Registered queries (Spark) and their DuckDB oracle SQL.

Each entry binds the driver's tables (see ``sources.driver``) and calls
one library operator over the whole tables.  ``as_of`` is fixed so that
relative windows are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventide.sources import driver as D
from eventide.sources.driver import AS_OF, oracle_events_cte as cte

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


# Window starts relative to AS_OF = 2024-01-31 00:00:00.
LO_24H = "2024-01-30 00:00:00"
LO_7D = "2024-01-24 00:00:00"
LO_30D = "2024-01-01 00:00:00"
LO_90D = "2023-11-02 00:00:00"


def _load_all() -> None:
    # Importing the modules registers their queries.
    from eventide import queries_raw, queries_rollup, queries_sessions, queries_profile  # noqa: F401
    from eventide import queries_lifecycle, queries_streaming  # noqa: F401


_load_all()
