"""All queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from colonnade.session import configure
from workload import matching, periods, plans, profiling, records

MODULES = (profiling, periods, matching, records, plans)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name."""
    return {name: configured(query) for module in MODULES for name, query in module.QUERIES.items()}


def configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with the library's settings put on its session first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def oracles() -> dict[str, str]:
    """SQL by query name."""
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query."""
    return plans.flagship(configure(spark), sf_dir)
