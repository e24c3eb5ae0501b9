"""Registry of the queries over the given tables and of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketlake.plans.inputs import oracle
from docketlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the same result in DuckDB's SQL."""
    def add(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[key] = configured
        if sql is not None:
            ORACLES[key] = oracle(sql)
        return run

    return add
