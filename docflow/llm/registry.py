"""Registration of this package's queries and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docflow.llm.common import bounded

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(bounded(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return function

    return register
