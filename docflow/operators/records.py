"""Building, checking, keying and counting records."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docflow.functions.files import iso_utc, message_key, size_is_bad, size_to_long, storage_path
from docflow.functions.text import text_length
from docflow.schemas import CHUNK_RECORD, FILE_RECORD, OWNERS, PARSE_STATUSES, PARSED_RECORD


def _checked(record: Column, reasons: list[Column]) -> tuple[Column, Column, Column]:
    reason = F.coalesce(*reasons, F.lit(None).cast("string"))
    return record.alias("value"), reason.isNull().alias("valid"), reason.alias("reason")


def _when(bad: Column, reason: str) -> Column:
    return F.when(bad, F.lit(reason))


def file_records(
    listed: DataFrame,
    keep: list[str] | None = None,
    null_policy: str = "default",
    keep_owners: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """Listed files as keyed records: `keep` columns, key, value, valid, reason.

    `null_policy` says what a null id, name or parent list is: "default" takes it for a missing field and fills
    it, "reject" takes it for an explicit null, which the record does not allow. Owners are written empty unless
    `keep_owners`.
    """
    if null_policy not in ("default", "reject"):
        raise ValueError("null_policy must be 'default' or 'reject'")
    has = set(listed.columns)

    def field(name: str) -> Column:
        return F.col(name) if name in has else F.lit(None).cast(FILE_RECORD[name].dataType)

    size = field("size")
    size_type = listed.schema["size"].dataType if "size" in has else FILE_RECORD["size"].dataType
    no_owners = F.array().cast(OWNERS)
    filled = {
        "id": F.coalesce(field("id"), F.lit("")),
        "name": F.coalesce(field("name"), F.lit("")),
        "size": size_to_long(size, size_type),
        "parents": F.coalesce(field("parents"), F.array().cast("array<string>")),
        "owners": F.coalesce(field("owners"), no_owners) if keep_owners else no_owners,
    }
    value = F.struct(*[filled.get(f.name, field(f.name)).alias(f.name) for f in FILE_RECORD])
    reasons = [
        _when(size_is_bad(size), "size is not a number"),
        _when(F.coalesce(F.exists("parents", lambda p: p.isNull()), F.lit(False)), "parents holds a null")
        if "parents" in has
        else F.lit(None).cast("string"),
    ]
    if null_policy == "reject":
        reasons += [_when(field(n).isNull(), f"{n} is null") for n in ("id", "name", "parents")]
    return listed.select(*(keep or []), message_key(filled["id"], now).alias("key"), *_checked(value, reasons))


def parsed_reasons(value: str = "value") -> list[Column]:
    """Why a parsed-file record breaks its schema."""
    required = [f.name for f in PARSED_RECORD if not f.nullable]
    return [_when(F.col(f"{value}.{n}").isNull(), f"{n} is null") for n in required] + [
        _when(~F.col(f"{value}.parseStatus").isin(PARSE_STATUSES), "parseStatus is not allowed")
    ]


def check_parsed(records: DataFrame) -> DataFrame:
    """Add `valid` and `reason` to parsed-file records."""
    reason = F.coalesce(*parsed_reasons())
    return records.withColumn("valid", reason.isNull()).withColumn("reason", reason)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    return checked.filter("valid").drop("valid", "reason"), checked.filter(~F.col("valid")).drop("valid")


def parsed_record(
    file_id: Column,
    name: Column,
    mime_type: Column,
    modified: Column,
    length: Column,
    status: Column | None = None,
    error: Column | None = None,
    now: Column | None = None,
) -> Column:
    """Parsed-file record of a file whose text is stored under its path."""
    values = {
        "id": file_id,
        "name": name,
        "mimeType": mime_type,
        "modifiedTime": modified,
        "storagePath": storage_path(file_id),
        "textLength": length.cast("long"),
        "parseTimestamp": iso_utc(now),
        "parseStatus": F.lit("success") if status is None else status,
        "errorMessage": F.lit(None).cast("string") if error is None else error,
    }
    return F.struct(*[values[f.name].alias(f.name) for f in PARSED_RECORD])


def parsed_from_text(file_id: Column, name: Column, mime_type: Column, modified: Column, text: Column, **options):
    """Parsed-file record of a file and its extracted text."""
    return parsed_record(file_id, name, mime_type, modified, text_length(text), **options)


def chunk_record(file_id: Column, file_name: Column, now: Column | None = None) -> Column:
    """Chunk record from the columns `chunk_documents` gives and the file's id and name."""
    given = {"fileId": file_id, "fileName": file_name, "chunkTimestamp": iso_utc(now)}
    return F.struct(*[given.get(f.name, F.col(f.name)).alias(f.name) for f in CHUNK_RECORD])


def delivery_counts(checked: DataFrame, by: list[str]) -> DataFrame:
    """success, failure and total per batch."""
    return checked.groupBy(*by).agg(
        F.count_if("valid").alias("success"),
        F.count_if(~F.col("valid")).alias("failure"),
        F.count("*").alias("total"),
    )


def run_totals(counts: DataFrame) -> DataFrame:
    """processed, sent and failed over all batches; zeros if there is none."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    return counts.agg(
        total("total").alias("processed"), total("success").alias("sent"), total("failure").alias("failed")
    )


def to_json_messages(records: DataFrame) -> DataFrame:
    """Topic rows with the value as JSON text, nulls written out."""
    return records.withColumn("value", F.to_json("value", {"ignoreNullFields": "false"}))


def from_json_messages(messages: DataFrame, record) -> DataFrame:
    """Topic rows with the value read back by its declared schema; a malformed value is null and has a reason."""
    raw = F.col("value").cast("string")
    fields = T.StructType([*record.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(raw, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    read = messages.withColumn("_parsed", parsed)
    bad = raw.isNotNull() & (F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull())
    value = F.when(~bad & raw.isNotNull(), F.struct(*[F.col("_parsed")[n].alias(n) for n in record.names]))
    reason = F.when(bad, F.lit("value is malformed"))
    return read.withColumns({"value": value, "reason": reason}).drop("_parsed")


def to_avro_messages(records: DataFrame, avro_schema: str) -> DataFrame:
    """Topic rows with the value as Avro bytes of a schema in JSON; needs Spark's Avro package."""
    from pyspark.sql.avro.functions import to_avro

    return records.withColumn("value", to_avro("value", avro_schema))


def from_avro_messages(messages: DataFrame, avro_schema: str) -> DataFrame:
    """Topic rows with the value read from Avro bytes; needs Spark's Avro package."""
    from pyspark.sql.avro.functions import from_avro

    return messages.withColumn("value", from_avro("value", avro_schema))
