"""Registration of queries and of the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamwork.sources.catalog import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``, with its SQL twin when there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
