"""Keyed lookups. All are equi-joins; Spark picks broadcast or sort-merge by measured size and splits hot keys."""

from pyspark.sql import DataFrame, functions as F


def with_status(parsed: DataFrame, status: str = "success", column: str = "parseStatus") -> DataFrame:
    return parsed.filter(F.col(column) == status)


def with_path(parsed: DataFrame, column: str = "storagePath") -> DataFrame:
    """Rows whose storage path is neither null nor empty."""
    return parsed.filter(F.length(column) > 0)


def with_content(rows: DataFrame, column: str = "content") -> DataFrame:
    """Rows whose content is neither null nor empty."""
    return rows.filter(F.length(column) > 0)


def content_lookup(parsed: DataFrame, store: DataFrame, path: str = "storagePath") -> DataFrame:
    """Parsed files with their stored text; files without one are left out."""
    content = with_content(store.select(F.col("path").alias(path), "content"))
    return parsed.join(content, path)


def bytes_lookup(files: DataFrame, content: DataFrame, key: str = "id") -> DataFrame:
    """Files with their bytes; `found` is false where there are none."""
    held = content.select(key, "content", F.lit(True).alias("_held"))
    return (
        files.join(held, key, "left").withColumn("found", F.coalesce(F.col("_held"), F.lit(False))).drop("_held")
    )


def existing(rows: DataFrame, store: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose path is in the store."""
    return rows.join(store.select(F.col("path").alias(path)), path, "left_semi")


def missing(rows: DataFrame, store: DataFrame, path: str = "path") -> DataFrame:
    """Rows whose path is not in the store."""
    return rows.join(store.select(F.col("path").alias(path)), path, "left_anti")
