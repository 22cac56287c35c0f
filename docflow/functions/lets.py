"""Binding a value inside a Column expression."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often the body names it.

    Spark does not share repeated subexpressions inside the lambdas of higher-order functions.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
