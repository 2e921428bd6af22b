"""Registry of named queries: a Spark job and (where SQL can say it) the
equivalent DuckDB SQL over the same parquet tables.

Every job reads the driver's tables (or tables Spark derives from them) in
full; nothing is sampled, capped or filtered by id to make checks cheap. The
only limits are the ones that are the feature (top-k cut, display cut, page).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a (spark, sf_dir) -> DataFrame job under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from quire.plans import (q_analysis, q_evaluation, q_hygiene,  # noqa: F401
                             q_index, q_queries, q_ranking, q_significance, q_sources,
                             q_tuning)
