"""Aggregates over the earlier rows of a key, for keys of any size.

A window per key would put all rows of a hot key into one task. Here rows are aggregated per range of the order column, those results per
range of ranges, and so on; the earlier ranges' result is joined back. No task orders more than 2**RANGE_BITS rows of a key below the
top level.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGE_BITS = 16
LEVELS = 2


def _both(how: str, a: Column, b: Column) -> Column:
    """The aggregate of two results; null is the result of no rows."""
    if how == "sum":
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    return {"max": F.greatest, "min": F.least}[how](a, b)


def earlier(df: DataFrame, keys: list[str], order: str, sums: dict[str, tuple[str, Column]], levels: int = LEVELS) -> DataFrame:
    """Add for each name the aggregate ("sum", "max" or "min" of a column) over the rows of the same key with a smaller `order`.

    Null where there is none. `order` is a long, unique within a key; keys are not null.
    """
    valued = {f"_v_{name}": what for name, (_, what) in sums.items()}
    rows = _earlier(df.withColumns(valued), keys, order, {name: (how, f"_v_{name}") for name, (how, _) in sums.items()}, levels)
    return rows.drop(*valued)


def _earlier(df: DataFrame, keys: list[str], order: str, sums: dict[str, tuple[str, str]], levels: int) -> DataFrame:
    if levels == 0:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({name: F.call_function(how, F.col(value)).over(before) for name, (how, value) in sums.items()})
    up = f"_range{levels}"
    ranged = df.withColumn(up, F.shiftright(F.col(order), RANGE_BITS))
    parts = ranged.groupBy(*keys, up).agg(*(F.call_function(how, F.col(value)).alias(f"_p_{name}") for name, (how, value) in sums.items()))
    starts = _earlier(parts, keys, up, {f"_s_{name}": (how, f"_p_{name}") for name, (how, _) in sums.items()}, levels - 1)
    starts = starts.select(*keys, up, *(f"_s_{name}" for name in sums))
    within = Window.partitionBy(*keys, up).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # The join asks for the partitioning that the window has left.
    own = ranged.withColumns({name: F.call_function(how, F.col(value)).over(within) for name, (how, value) in sums.items()})
    joined = own.join(starts, [*keys, up])
    return joined.withColumns({name: _both(how, F.col(name), F.col(f"_s_{name}")) for name, (how, _) in sums.items()}).drop(
        up, *(f"_s_{name}" for name in sums)
    )
