"""Named queries over the given tables and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.plans.oracle import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *needs: str, recursive: bool = False):
    """Register a query; ``needs`` names the CTEs its SQL is put behind."""

    def keep(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql, *needs, recursive=recursive)
        return run

    return keep
