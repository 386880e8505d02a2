"""Queries of the library over the benchmark tables, with equivalent SQL.

Each query shapes the tables like the library's own, applies library operators
to them, and is held against SQL that states the result another way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tidemark.queries import checks, entities, loading, outputs, scalars  # noqa: F401

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
