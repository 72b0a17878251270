"""Registered queries: one per operator of the coverage list, each with
an equivalent DuckDB SQL oracle where SQL can express it.

Every query reads whole driver tables (``sf_dir``) and returns a lazy
DataFrame. Column names match the oracle's exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from strata.plans import q_market, q_history, q_storage, q_quality, q_metrics, q_stream  # noqa: F401


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
