"""Registry of query keys -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.expr import round_doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None, digits: int | None = 6, of: dict[str, int] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; doubles are rounded to ``digits`` decimals
    at the edge, columns in ``of`` to their own."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df, digits, of) if digits is not None else df
        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every catalog module (registration happens at import)."""
    from . import (catalog_backtest, catalog_drift, catalog_features,  # noqa: F401
                   catalog_model, catalog_monitor, catalog_reports, catalog_stress)
