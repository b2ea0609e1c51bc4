"""Reading the given tables for the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.plans.session import configure

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Named queries with the SQL that must give the same rows, where there is any."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def wrap(fn: Query) -> Query:
            name = fn.__name__
            self.queries[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
            if sql is not None:
                self.sql[name] = sql
            return fn

        return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
