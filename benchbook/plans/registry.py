"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from benchbook.plans.oracle import with_tables
from benchbook.sources.domain import Domain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of a Domain as the query name; sql: the same in DuckDB SQL."""

    def add(f: Callable[[Domain], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is there already")
        QUERIES[name] = lambda spark, sf_dir: f(Domain(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = with_tables(sql)
        return f

    return add
