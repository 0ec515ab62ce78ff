"""All queries by name, and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelens.bindings import (
    clinical_queries,
    observation_queries,
    pickup_queries,
    record_queries,
    report_queries,
)
from carelens.session import tune

_MODULES = (observation_queries, pickup_queries, record_queries, clinical_queries, report_queries)

Query = Callable[[SparkSession, str], DataFrame]


def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _tuned(q) for module in _MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
