"""Registry of named queries: ``name -> (spark callable, oracle SQL or None)``.

A query callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables.  Its oracle, when the result is expressible in SQL, is a
DuckDB statement over the same tables with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    from sparkdeck.plans import (  # noqa: F401
        features_q,
        io_q,
        models_q,
        profile_q,
        ratings_q,
        relational_q,
        scale_q,
        text_q,
    )
