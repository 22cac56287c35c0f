"""Changed-since-last over a stream: the batch rule on each micro-batch, with the last kept times as a table."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from docflow.operators.changes import latest_per_key, mark_changed
from docflow.session import configure
from docflow.sources.runs import Runs


def keep_changed(rows: DataFrame, key: str, order: str, modified: str, success: str, path: str, number: int) -> None:
    """Write the rows of micro-batch `number` that changed since the last successful one of their key, and the state after it.

    The rule is that of `mark_changed`, so a key with very many rows is cut into segments. The state is a table of levelled runs with a row per
    key: a micro-batch reads the buckets its keys are in and adds the keys it moves, whatever the number of keys and micro-batches there
    were. One that comes again replaces what it wrote. Micro-batches must come in order.
    """
    state = last_kept(rows, key, modified, path)
    last = state.read(number - 1, rows).select(key, modified)
    marked = mark_changed(rows, key, order, modified, F.col(success), last).filter("changed").drop("changed")
    marked.write.mode("overwrite").parquet(f"{path}/rows/number={number}")
    kept = rows.sparkSession.read.schema(marked.schema).parquet(f"{path}/rows/number={number}").filter(F.col(success))
    state.append(latest_per_key(kept.select(key, order, modified), key, order), number)


def last_kept(like: DataFrame, key: str, modified: str, path: str) -> Runs:
    """The last kept time of each key."""
    return Runs(like.sparkSession, f"{path}/state", like.select(key, modified).schema, key)


def read_changed(spark: SparkSession, path: str) -> DataFrame:
    """All rows kept so far."""
    return spark.read.parquet(f"{path}/rows").drop("number")


def changed_writer(
    df: DataFrame, key: str, order: str, modified: str, success: str, path: str, checkpoint: str
) -> DataStreamWriter:
    """Rows of any stream that changed since the last successful one of their key, to `path`; see `keep_changed`."""

    def run(rows: DataFrame, number: int) -> None:
        configure(rows.sparkSession)
        keep_changed(rows, key, order, modified, success, path, number)

    return df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
