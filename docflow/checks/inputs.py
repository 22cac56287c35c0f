"""The driver tables in the roles of this library's inputs, in Spark and in SQL.

events: change feed and listing of files; documents: stored texts; pages: file bytes; conversations: page texts
of files; labels: paths to look up, save again or delete.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.functions.files import storage_path
from docflow.operators.records import file_records
from docflow.schemas import LISTED_FILE
from docflow.session import work_folder
from docflow.sources.files import write_files

PER_PAGE = 100

MIME_TYPES = {
    "view": "application/pdf",
    "click": "application/vnd.google-apps.document",
    "purchase": "application/vnd.google-apps.spreadsheet",
    "signup": "text/plain",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table for work that is heavy per row: if its scan has fewer splits than there are cores, rows are dealt out."""
    df = table(spark, sf, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


# --- events -----------------------------------------------------------------------------------


def events(spark: SparkSession, sf: str) -> DataFrame:
    """offset, id, k, mimeType, modifiedTime and what else the file records are made of."""
    k = F.get_json_object("props", "$.k").cast("int")
    mime = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    rows = table(spark, sf, "events").withColumn("k", k)
    day = F.date_sub(F.to_date("ts"), F.col("k") % 3)
    return rows.select(
        F.col("event_id").alias("offset"),
        F.floor(F.col("event_id") / PER_PAGE).alias("page_no"),
        F.col("user_id").cast("string").alias("id"),
        "event_type",
        "k",
        F.concat_ws("_", "event_type", "event_id").alias("name"),
        F.try_element_at(mime, "event_type").alias("mimeType"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdTime"),
        F.when(F.col("k") != 0, F.date_format(day, "yyyy-MM-dd'T00:00:00Z'")).alias("modifiedTime"),
        F.when(F.col("k") % 7 == 0, None)
        .when(F.col("k") % 50 == 49, "abc")
        .otherwise(F.col("k").cast("string"))
        .alias("size"),
    )


EVENTS = f"""ev AS (
  SELECT event_id AS "offset", event_id // {PER_PAGE} AS page_no, event_id % {PER_PAGE} AS pos,
    CAST(user_id AS VARCHAR) AS id, event_type, k, event_type || '_' || event_id AS name,
    CASE event_type WHEN 'view' THEN 'application/pdf' WHEN 'click' THEN 'application/vnd.google-apps.document'
      WHEN 'purchase' THEN 'application/vnd.google-apps.spreadsheet' WHEN 'signup' THEN 'text/plain' END AS mimeType,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS createdTime,
    CASE WHEN k <> 0 THEN strftime(CAST(ts AS DATE) - k % 3, '%Y-%m-%dT00:00:00Z') END AS modifiedTime,
    CASE WHEN k % 7 = 0 THEN NULL WHEN k % 50 = 49 THEN 'abc' ELSE CAST(k AS VARCHAR) END AS size
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def listed(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a listing sends them: some ids, names and parents are not there."""
    k = F.col("k")
    return events(spark, sf).select(
        "offset",
        "page_no",
        F.when(k != 1, F.col("id")).alias("id"),
        F.when(k != 2, F.col("name")).alias("name"),
        "mimeType",
        "createdTime",
        "modifiedTime",
        "size",
        F.when(F.col("event_type") == "view", F.concat(F.lit("https://view.example/"), "offset")).alias("webViewLink"),
        F.lit(None).cast("string").alias("webContentLink"),
        F.when(k > 50, F.array(F.concat(F.lit("folder_"), "event_type"))).alias("parents"),
        F.array(F.struct(F.col("id").alias("displayName"), F.lit(None).cast("string").alias("emailAddress"))).alias(
            "owners"
        ),
    )


LISTED = (
    EVENTS
    + """, li AS (
  SELECT "offset", page_no, pos, CASE WHEN k <> 1 THEN id END AS id, CASE WHEN k <> 2 THEN name END AS name, mimeType,
    createdTime, modifiedTime, size, CASE WHEN event_type = 'view' THEN 'https://view.example/' || "offset" END AS webViewLink,
    CAST(NULL AS VARCHAR) AS webContentLink, CASE WHEN k > 50 THEN 'folder_' || event_type END AS parents
  FROM ev)"""
)


def land_pages(spark: SparkSession, sf: str, emptied: bool = False) -> str:
    """Write the listing as JSON pages of 100 files, with one unknown field; `emptied` clears a page two thirds in."""
    fields = [F.col(f.name) for f in LISTED_FILE]
    file = F.struct("offset", F.struct(*fields, F.lit("never read").alias("kind")).alias("file"))
    files = listed(spark, sf)
    last = files.agg(F.max("page_no")).scalar()
    pages = files.groupBy("page_no").agg(F.array_sort(F.collect_list(file)).alias("files"))
    content = F.transform("files", lambda f: f["file"])
    if emptied:
        content = F.when(F.col("page_no") != F.floor(last * 2 / 3), content).otherwise(F.slice(content, 1, 0))
    token = F.when(F.col("page_no") < last, F.concat(F.lit("t"), F.col("page_no") + 1))
    path = work_folder(spark, "pages")
    pages.select("page_no", content.alias("files"), token.alias("nextPageToken")).write.json(path)
    return path


def file_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as messages of the files topic: key, offset, value."""
    return file_records(events(spark, sf), ["offset"]).select("key", "offset", "value")


# --- pages ------------------------------------------------------------------------------------


def file_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of the files with even ids, so that half of the files of the change feed have none."""
    return table(spark, sf, "pages").select(
        (F.col("page_id") * 2).cast("string").alias("id"), F.encode("html", "UTF-8").alias("content")
    )


def land_files(spark: SparkSession, sf: str) -> str:
    """Write each page as a file of its own, named by its id. The writer ends a file with a newline."""
    path = work_folder(spark, "files")
    pages = spread(spark, sf, "pages", "page_id")
    write_files(pages.select((F.col("page_id") * 2).alias("id"), F.col("html").alias("value")), path, "id", "value")
    return path


def landed_id(path: Column) -> Column:
    """Id of a file of `land_files`."""
    return F.regexp_extract(path, r"/id=(\d+)\.[^/]*$", 1)


# --- documents --------------------------------------------------------------------------------


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files: offset, id, name, mimeType, modifiedTime, text, status."""
    return spread(spark, sf, "documents", "doc_id").select(
        F.col("doc_id").alias("offset"),
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.col("source"), F.lit("_"), F.col("doc_id"), F.lit(".txt")).alias("name"),
        F.lit("text/plain").alias("mimeType"),
        F.concat(F.lit("2024-01-01T00:00:00Z/"), "lang").alias("modifiedTime"),
        "text",
        "lang",
        F.when(F.col("n_chars") < 100, "skipped").when(F.col("lang") == "de", "failed").otherwise("success").alias("status"),
    )


DOCUMENTS = """doc AS (
  SELECT doc_id AS "offset", CAST(doc_id AS VARCHAR) AS id, source || '_' || doc_id || '.txt' AS name,
    'text/plain' AS mimeType, '2024-01-01T00:00:00Z/' || lang AS modifiedTime, text, lang,
    'parsed/' || doc_id || '.txt' AS path,
    CASE WHEN n_chars < 100 THEN 'skipped' WHEN lang = 'de' THEN 'failed' ELSE 'success' END AS status
  FROM documents)"""


def store_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as rows to save."""
    return documents(spark, sf).select(
        storage_path(F.col("id")).alias("path"),
        F.col("text").alias("content"),
        F.create_map(F.lit("file_name"), "name").alias("metadata"),
        F.col("offset").alias("seq"),
    )


def noisy(text: str = "text"):
    """Text with separators, control and no-break characters in place of some letters."""
    return F.translate(F.col(text), "xvkq", "\x1c\x01 \x7f")


NOISY = "translate(text, 'xvkq', chr(28) || chr(1) || chr(160) || chr(127))"


def wanted_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of the labelled documents; those of toxic ones are not in the store."""
    absent = F.when(F.col("toxic") == 1, "absent_").otherwise("")
    return table(spark, sf, "labels").select(F.concat(F.lit("parsed/"), absent, "doc_id", F.lit(".txt")).alias("path"))


WANTED = """wanted AS (
  SELECT 'parsed/' || CASE WHEN toxic = 1 THEN 'absent_' ELSE '' END || doc_id || '.txt' AS path FROM labels)"""
