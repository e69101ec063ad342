"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable (spark, sf_dir) -> DataFrame reading the driver's
tables through the fixture views; each oracle is an independent SQL
formulation (written in the reference's shape where that differs from
ours) run by DuckDB on the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLE[key] = oracle
        return run
    return deco


def alias(key: str, target: str) -> None:
    """Register `key` as another name for `target` (same code, same oracle)."""
    QUERIES[key] = QUERIES[target]
    if target in ORACLE:
        ORACLE[key] = ORACLE[target]


def load_all() -> None:
    from . import (catalog_features, catalog_basic, catalog_quotes,  # noqa: F401
                   catalog_tables, catalog_stats, catalog_streams, catalog_live, catalog_models)
