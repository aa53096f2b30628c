"""Where queries register themselves together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(pin_session(spark), sf_dir)

        QUERIES[name] = pinned
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
