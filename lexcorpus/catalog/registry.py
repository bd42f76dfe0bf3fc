"""Names of queries, the jobs behind them, and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexcorpus.catalog.inputs import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a job under ``name``; ``sql`` is its SQL form, if it has one."""

    def add(job: Query) -> Query:
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return job

    return add
