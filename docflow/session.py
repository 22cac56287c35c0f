"""Session settings and the shared work folder."""

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # ISO strings are compared as text, clock columns must print UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # File bytes are wide: bound an Arrow batch by size, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # A micro-batch of landed files lists each of them: by default in a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # State grows with the number of files: keep it off the heap and checkpoint what changed only.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Only settable when a session is built. Recording a call site for every Column costs more than building the plan.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library's results and memory bounds rest on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application; not needed where it is installed on them."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="docflow-")) / package.name
        context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder the cluster names.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="docflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/docflow/{name}-{uuid.uuid4().hex}"


# The shuffle files of a job go when it ends; else when the driver's collector finds that no plan needs them.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """The rows, written to a fresh work folder and read from there: computed once, and there if executors are lost.

    With `tidy` the shuffle files of the job that writes them are removed right after it.
    """
    spark = df.sparkSession
    path, before = work_folder(spark, name), spark.conf.get(TIDY)
    try:
        if tidy:
            spark.conf.set(TIDY, "true")
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)
