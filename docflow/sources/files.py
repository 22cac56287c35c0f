"""File bytes by id or by path.

`read_bytes` is a table of all files with their bytes. `index` has their paths and sizes only: a job decides on it which files it wants, and
the tasks that want them open those and no others. `write_files` lands rows as files. `note_landed` lists a folder in tasks and logs what is
new there: a stream follows that log, so its driver knows a name for each thousand landed files and not the files.
"""

from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.functions.files import path_stem
from docflow.sources import folders

FILE = "path string, modificationTime timestamp, length long, content binary"
LANDED = "path string, length long, landed timestamp"
# Files of a folder: it is listed by one call. Also those that a file of the log of landed files names.
FOLDER = 1000
# Bytes of the files that a task opens before it hands them on.
OPENED = 4 << 20


def file_id(path: Column) -> Column:
    """Id of a landed file: the stem of its name."""
    return path_stem(path)


def read_bytes(spark: SparkSession, path: str, id_of: Callable[[Column], Column] = file_id) -> DataFrame:
    """(id, content) of the files under `path`; `id_of` gets the id out of a file's path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(id_of(F.col("path")).alias("id"), "content")


def index(spark: SparkSession, path: str, id_of: Callable[[Column], Column] = file_id) -> DataFrame:
    """(id, path, length, landed) of the files under `path`, without opening any."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(id_of(F.col("path")).alias("id"), "path", "length", F.col("modificationTime").alias("landed"))


def _place(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def open_path(path: str) -> bytes:
    """The bytes of a file, from inside a task. Schemes other than local files need their file system on the workers."""
    system, place = _place(path)
    with system.open_input_stream(place) as stream:
        return stream.read()


def write_files(rows: DataFrame, path: str, key: str, line: str) -> None:
    """Write the lines of each key as a file `<key>=<value>.txt`, a thousand files to a folder; a null line is an empty one.

    The tasks that have the rows write the files, with no folder per file to make, move and list: of a key with rows in several
    partitions there is a file from each. A task that runs again writes the same files again. Schemes are those of `open_path`.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _place(path)
        part, done, last, stream = TaskContext.get().partitionId(), 0, None, None
        try:
            for batch in batches:
                for value, text in zip(batch.column(0), batch.column(1)):
                    if stream is None or value != last:
                        if stream is not None:
                            stream.close()
                        folder = f"{place}/part={part}-{done // FOLDER}"
                        if done % FOLDER == 0:
                            system.create_dir(folder)
                        stream, last, done = system.open_output_stream(f"{folder}/{key}={quote(str(value.as_py()), safe='')}.txt"), value, done + 1
                    stream.write((text.as_py() or b"") + b"\n")
        finally:
            if stream is not None:
                stream.close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["files"])

    # One key's lines next to each other: the order of the keys among themselves does not matter.
    lines = rows.select(key, F.encode(line, "UTF-8").alias("line")).sortWithinPartitions(key)
    _place(path)[0].create_dir(_place(path)[1], recursive=True)
    lines.mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()


def listable(path: str) -> bool:
    """Whether tasks can list a path: it is no pattern, and has a scheme of `open_path`."""
    try:
        return not set(path) & set("*?[]{}\\") and bool(_place(path))
    except (ValueError, OSError, ImportError):
        return False


def _listed(there: DataFrame) -> DataFrame:
    """What is in some folders, other folders too. As in Spark's own listings, names that begin with a dot or an underscore are hidden."""

    def hidden(name: str) -> bool:
        return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        types = (pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC"))
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            system, place = _place(path)
            own = system.get_file_info(place)
            found = [own] if own.is_file else [f for f in system.get_file_info(fs.FileSelector(place)) if not hidden(f.base_name)]
            scheme = "file:" if path.startswith(("file:", "/")) else path.rstrip("/").removesuffix(place.rstrip("/"))
            for start in range(0, len(found), 10 * FOLDER):
                part = found[start : start + 10 * FOLDER]
                # Milliseconds, as Spark's listings have them.
                rows = ((scheme + f.path, not f.is_file, f.size or 0, (f.mtime_ns or 0) // 1_000_000 * 1000) for f in part)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["path", "folder", "length", "landed"])

    return there.mapInArrow(run, "path string, folder boolean, length long, landed timestamp")


def note_landed(spark: SparkSession, path: str, log: str, most: int = FOLDER) -> None:
    """Add the files that are under `path` and not yet in the log to it, at most `most` to a file of the log.

    Folders are listed by tasks, a level of them at a time. What an ended call left in the log is whole files of it; the next call adds the rest.
    """
    tasks = spark.sparkContext.defaultParallelism
    levels, there = [], spark.createDataFrame([(path,)], "path string")
    try:
        while not levels or not there.isEmpty():
            levels.append(_listed(there.repartition(tasks, "path")).persist(StorageLevel.DISK_ONLY))
            there = levels[-1].filter("folder").select("path")
        found = levels[0]
        for level in levels[1:]:
            found = found.unionByName(level)
        known = spark.read.schema(LANDED).parquet(log).select("path")
        new = found.filter("NOT folder").drop("folder").join(known, "path", "left_anti").persist(StorageLevel.DISK_ONLY)
        levels.append(new)
        if not new.isEmpty():
            new.write.option("maxRecordsPerFile", most).mode("append").parquet(log)
    finally:
        for level in levels:
            level.unpersist()


def _opened(landed: DataFrame) -> DataFrame:
    """path, landed and the bytes of files, opened by the tasks that have their paths. A file that is gone is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(some):
            types = (pa.string(), pa.binary(), pa.timestamp("us", "UTC"))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=["path", "content", "landed"])

        for batch in batches:
            some, size = [], 0
            for path, at in zip(*(batch.column(c).to_pylist() for c in ("path", "landed"))):
                some.append((path, open_path(path), at))
                size += len(some[-1][1])
                if size >= OPENED:
                    yield rows(some)
                    some, size = [], 0
            if some:
                yield rows(some)

    return landed.select("path", "landed").mapInArrow(run, "path string, content binary, landed timestamp")


def read_bytes_stream(
    spark: SparkSession, path: str, id_of: Callable[[Column], Column] = file_id, max_files: int = 1000, log: str | None = None
) -> DataFrame:
    """(id, content, landed) of files as they land.

    With the log that `note_landed` keeps of them, the stream follows the log and its tasks open the files. Without one the driver lists
    all files, and holds several kilobytes for each.
    """
    if log is None:
        reader = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", True)
        files = reader.option("maxFilesPerTrigger", max_files).load(path)
        return files.select(id_of(F.col("path")).alias("id"), "content", F.col("modificationTime").alias("landed"))
    folders.make(spark, log)
    names = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", max(1, max_files // FOLDER)).parquet(log)
    # Names are small and files are not: splits of the log would be too few tasks.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _opened(names.repartition(tasks, "path")).select(id_of(F.col("path")).alias("id"), "content", "landed")


def read_paths(wanted: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Wanted paths with their bytes; null content where there is no such file."""
    return wanted.join(files.select(F.col("path").alias(path), "content"), path, "left")
