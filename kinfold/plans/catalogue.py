"""The library's own queries over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query that takes (spark, sf_dir), with the SQL that gives the same rows."""

    def add(function):
        _queries[name] = function
        if sql:
            _sql[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    from kinfold.plans import merging, scalars, serving  # noqa: F401  they register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(sorted(_queries.items()))


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
