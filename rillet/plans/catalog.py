"""Registry of named queries: a Spark builder and, where SQL can express it,
the DuckDB oracle text. ``__spark_entry__`` exposes both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql() if callable(sql) else sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from rillet.plans import queries  # noqa: F401
