"""Named queries and, where SQL can say the same, the statement to check them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeledger.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``check`` is SQL over the same tables."""
    def register(fn):
        from lakeledger.plans.tables import Tables

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if check:
            CHECKS[name] = check
        return fn
    return register
