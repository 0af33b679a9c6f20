"""Where the plans register their queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under ``name``, with the SQL that gives the same rows."""

    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return register
