"""Registration of checks: a query on the driver tables and, where SQL can say the same, the SQL."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return register


def filled(number: Column) -> Column:
    """A number that may be null as a long, -1 for null."""
    return F.coalesce(number.cast("long"), F.lit(-1).cast("long"))
