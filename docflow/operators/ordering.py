"""Arrival order at scale: running totals, ordinals, batches and the limits that follow from them.

A window over a whole table would put every row into one task. Here rows are summed up per range of the order
column, those sums per range of ranges, and so on: no task ever orders more than 2**RANGE_BITS rows.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGE_BITS = 20
# Three levels of ranges leave at most 2**(64 - 3 * 20) sums for the last window, whatever the order values are.
LEVELS = 3


def running_total(df: DataFrame, order: str, amount: Column | None = None, name: str = "before") -> DataFrame:
    """Add `name`: the sum of `amount` (default: the row count) over the rows before this one by `order`.

    `order` is a unique long. The rows are shuffled once, by range of `order`; the join of the range starts uses
    the same partitioning.
    """
    amount = F.lit(1).cast("long") if amount is None else amount.cast("long")
    return _add_before(df.withColumn("_amount", amount), order, name, LEVELS).drop("_amount")


def _add_before(df: DataFrame, order: str, name: str, levels: int) -> DataFrame:
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    if levels == 0:
        return df.withColumn(name, F.coalesce(F.sum("_amount").over(earlier), F.lit(0)))
    up, start = f"_range{levels}", f"_start{levels}"
    ranged = df.withColumn(up, F.shiftright(F.col(order), RANGE_BITS))
    sums = ranged.groupBy(up).agg(F.sum("_amount").alias("_amount"))
    starts = _add_before(sums, up, start, levels - 1).select(up, start)
    within = Window.partitionBy(up).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn(name, F.coalesce(F.sum("_amount").over(within), F.lit(0)))
        .join(starts, up)
        .withColumn(name, F.col(name) + F.col(start))
        .drop(up, start)
    )


def number_batches(df: DataFrame, order: str, batch_size: int, name: str = "batch") -> DataFrame:
    """Add the number of the fixed-size batch each row falls into, in order of `order`."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    numbered = running_total(df, order, name=name)
    return numbered.withColumn(name, F.floor(F.col(name) / batch_size).cast("long"))


def first_rows(df: DataFrame, order: str, max_rows: int | None) -> DataFrame:
    """The first `max_rows` rows by `order`; None gives all of them."""
    return df if max_rows is None else df.orderBy(order).limit(max_rows)


def pages_within(pages: DataFrame, page: str, rows: Column, max_rows: int | None) -> DataFrame:
    """Pages as long as the `rows` of the pages before sum up to fewer than `max_rows`; None or 0: no limit."""
    if not max_rows:
        return pages
    return running_total(pages, page, rows, "_before").filter(F.col("_before") < max_rows).drop("_before")


def limit_by_pages(df: DataFrame, page: str, max_rows: int | None) -> DataFrame:
    """Rows of whole pages, as long as the rows on the pages before number fewer than `max_rows`."""
    if not max_rows:
        return df
    pages = df.groupBy(page).agg(F.count("*").alias("rows"))
    last = pages_within(pages, page, F.col("rows"), max_rows).agg(F.max(page).alias("last"))
    return df.filter(F.col(page) <= last.scalar())


def until_empty_page(pages: DataFrame, page: str = "page_no", rows: Column | None = None) -> DataFrame:
    """Pages before the first one without files; `rows` is their number, by default that of the list `files`."""
    rows = F.size("files") if rows is None else rows
    empty = pages.filter(F.coalesce(rows, F.lit(0)) <= 0).agg(F.min(page).alias("first_empty"))
    limit = F.coalesce(empty.scalar(), F.lit(2**63 - 1))
    return pages.filter(F.col(page) < limit)
