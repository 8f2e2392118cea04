"""The registered queries, each with its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changefeed.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = configured
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load_all() -> None:
    from changefeed.queries import (  # noqa: F401
        capture_queries,
        log_queries,
        read_queries,
        rule_queries,
        verdict_queries,
    )
