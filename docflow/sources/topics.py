"""Keyed topics on files with a commit log, and the same on Kafka where its package is present.

A topic row is (key, offset, value); `value` is a struct of the topic's record, so that scans read and filter single
fields. `accepted=false` holds rejected rows with their reason: one write carries both, and a reader of either
half never opens the other. `partition` is a hash of the key. A hot key makes a large partition, not a large
file: its rows go to several files, and `offset` keeps their order.

Each write goes to a fresh folder and counts from when its marker is in the log: readers know folders from markers only. A write is
named by its run and its number there; writing the same again is no write. So no reader sees a batch in part or twice, and a
stream, which reads markers, gets all files of a batch in one micro-batch. A topic has one writer at a time.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from docflow.operators.records import from_json_messages, to_json_messages
from docflow.schemas import message_schema
from docflow.session import configure
from docflow.sources import folders

PARTITIONS = 16
MARKER = "run string, number long, batch_id long, folder string, accepted long, rejected long"


def _stored_schema(record: T.StructType) -> T.StructType:
    return (
        message_schema(record)
        .add("reason", T.StringType())
        .add("accepted", T.BooleanType())
        .add("partition", T.IntegerType())
    )


def _laid_out(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows with their topic partition, brought together by it. Spark splits partitions too large for one task."""
    reason = F.col("reason") if "reason" in rows.columns else F.lit(None).cast("string")
    return rows.select(
        "key",
        F.col("offset").cast("long").alias("offset"),
        "value",
        reason.alias("reason"),
        reason.isNull().alias("accepted"),
        F.pmod(F.hash("key"), F.lit(partitions)).alias("partition"),
    ).hint("rebalance", "partition")


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The log of a topic: a row per write."""
    if not folders.exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], MARKER)
    return spark.read.schema(MARKER).json(f"{path}/commits")


def batch_of(spark: SparkSession, path: str, run: str, number: int | None) -> tuple[int, bool]:
    """The batch id of a write, and whether it was made already. A new write gets the next id of the topic."""
    log = commits(spark, path)
    last = F.max("batch_id").alias("last")
    found = log.agg(last, F.max(F.when((F.col("run") == run) & (F.col("number") == F.lit(number)), F.col("batch_id"))).alias("own")).first()
    if number is not None and found["own"] is not None:
        return found["own"], True
    return (0 if found["last"] is None else found["last"] + 1), False


def write_topic(
    rows: DataFrame, path: str, number: int | None = None, run: str = "", partitions: int = PARTITIONS
) -> dict[str, int]:
    """Write one batch: number `number` of a run, or one more batch of its own. The same number again writes nothing.

    Returns batch_id and the numbers of accepted and rejected rows of the batch.
    """
    spark = rows.sparkSession
    batch_id, done = batch_of(spark, path, run, number)
    if done:
        marker = commits(spark, path).filter(F.col("batch_id") == batch_id).select("batch_id", "accepted", "rejected")
        return marker.first().asDict()
    seen = Observation()
    folder = f"{path}/data/batch_id={batch_id}/write={uuid.uuid4().hex}"
    accepted, rejected = F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")
    (
        _laid_out(rows, partitions)
        .observe(seen, accepted, rejected)
        .sortWithinPartitions("accepted", "partition", "key", "offset")
        .write.partitionBy("accepted", "partition")
        .parquet(folder)
    )
    counts = {"accepted": seen.get["accepted"], "rejected": seen.get["rejected"]}
    marker = [(run, batch_id if number is None else number, batch_id, folder, counts["accepted"], counts["rejected"])]
    spark.createDataFrame(marker, MARKER).coalesce(1).write.mode("append").json(f"{path}/commits")
    return {"batch_id": batch_id, **counts}


def _read_folders(spark: SparkSession, path: str, of: list[str], record: T.StructType) -> DataFrame:
    schema = _stored_schema(record).add("batch_id", T.LongType()).add("write", T.StringType())
    # A batch without rows has a folder without files.
    if not of:
        return spark.createDataFrame([], schema).drop("write")
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*of).drop("write")


def read_rows(spark: SparkSession, path: str, record: T.StructType, batches: Column | None = None) -> DataFrame:
    """All a topic holds, messages and rejects, with topic partition and batch; `batches` is a condition on batch_id.

    Only the folders of these batches are listed.
    """
    log = commits(spark, path)
    log = log if batches is None else log.filter(batches)
    return _read_folders(spark, path, [r.folder for r in log.select("folder").collect()], record)


def read_topic(spark: SparkSession, path: str, record: T.StructType, batches: Column | None = None) -> DataFrame:
    """Accepted messages from the earliest on."""
    return read_rows(spark, path, record, batches).filter("accepted").select("key", "offset", "value")


def read_rejects(spark: SparkSession, path: str, record: T.StructType, batches: Column | None = None) -> DataFrame:
    """Rejected rows with their reason."""
    return read_rows(spark, path, record, batches).filter(~F.col("accepted")).select("key", "offset", "value", "reason")


def follow(
    spark: SparkSession, path: str, record: T.StructType, handle: Callable[[DataFrame, int], None], checkpoint: str,
    max_batches: int | None = None,
) -> DataStreamWriter:
    """A stream over a topic from the earliest batch on: handle(messages, number) for each micro-batch.

    A micro-batch is whole batches, at most `max_batches` of them, whatever the number of their files. One that failed comes
    again under the same number.
    """
    reader = spark.readStream.schema(MARKER)
    markers = (reader if max_batches is None else reader.option("maxFilesPerTrigger", max_batches)).json(f"{path}/commits")

    def run(batch: DataFrame, number: int) -> None:
        session = configure(batch.sparkSession)
        rows = _read_folders(session, path, [r.folder for r in batch.select("folder").distinct().collect()], record)
        handle(rows.filter("accepted").select("key", "offset", "value"), number)

    counted = markers.observe("topic", F.sum("accepted").alias("rows"))
    return counted.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def copy_stage(spark: SparkSession, source: str, record: T.StructType, target: str, checkpoint: str, **options) -> DataStreamWriter:
    """The messages of a topic to another topic."""

    def copy(messages: DataFrame, number: int) -> None:
        write_topic(messages, target, number, checkpoint)

    return follow(spark, source, record, copy, checkpoint, **options)


def topic_stream_writer(
    rows: DataFrame, path: str, checkpoint: str, partitions: int = PARTITIONS
) -> DataStreamWriter:
    """Append a stream to a topic, a micro-batch at a time. A stream with a new checkpoint is a new run: it adds batches."""

    def write(batch: DataFrame, number: int) -> None:
        write_topic(batch, path, number, checkpoint, partitions)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Run a stream over all there is now, then stop: the bounded drain of a topic."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_kafka(spark: SparkSession, servers: str, topic: str, record: T.StructType, **options: str) -> DataFrame:
    """Messages of a Kafka topic as a stream from the earliest offset; needs Spark's Kafka package.

    `offset` counts within a Kafka partition only, so the partition makes its low bits: unique, and rising per key. A value that is
    malformed has a reason.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
    offset = (F.shiftleft("offset", 16) + F.col("partition")).alias("offset")
    return from_json_messages(raw.select(F.col("key").cast("string"), offset, "value"), record)


def kafka_writer(rows: DataFrame, servers: str, topic: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """Stream of messages, without rejects, to a Kafka topic; needs Spark's Kafka package."""
    return (
        to_json_messages((rows.filter("reason IS NULL") if "reason" in rows.columns else rows).select("key", "value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
