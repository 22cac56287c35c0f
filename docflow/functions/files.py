"""Functions on file metadata: types, keys, paths, sizes, times."""

from pyspark.sql import Column, functions as F, types as T

from docflow.schemas import EXPORT_TYPES, PDF, PDF_TYPES, WORKSPACE_PREFIX

BYTES_PER_MB = 1024 * 1024
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def is_pdf(mime_type: Column) -> Column:
    """True for PDF and for Workspace documents, false for the rest and for null."""
    return F.coalesce(mime_type.isin(PDF_TYPES), F.lit(False))


def is_workspace_type(mime_type: Column) -> Column:
    return F.coalesce(mime_type.startswith(WORKSPACE_PREFIX), F.lit(False))


def export_type(mime_type: Column) -> Column:
    """Type the bytes of a file arrive in: Workspace files are exported, others keep their own."""
    known = F.create_map(*[F.lit(part) for pair in EXPORT_TYPES.items() for part in pair])
    return F.when(is_workspace_type(mime_type), F.coalesce(F.try_element_at(known, mime_type), F.lit(PDF))).otherwise(
        mime_type
    )


def chunk_id(file_id: Column, index: Column) -> Column:
    return F.concat(file_id, F.lit("_chunk_"), index.cast("string"))


def storage_path(file_id: Column) -> Column:
    return F.concat(F.lit("parsed/"), file_id, F.lit(".txt"))


def path_stem(path: Column) -> Column:
    """Last part of a path without its last suffix; a leading or trailing dot makes no suffix."""
    name = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def size_mb(content: Column) -> Column:
    return F.octet_length(content) / F.lit(float(BYTES_PER_MB))


def size_to_long(size: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Size as long: null and '' (or the number 0) give null, text that is no number gives null too.

    Use `size_is_bad` to tell the last case apart.
    """
    if isinstance(dtype, T.StringType):
        return F.nullif(size, F.lit("")).try_cast("long")
    return F.nullif(size.try_cast("long"), F.lit(0).cast("long"))


def size_is_bad(size: Column) -> Column:
    """Size is given, is not empty, and is no whole number."""
    text = size.cast("string")
    return F.coalesce((text != "") & text.try_cast("long").isNull(), F.lit(False))


def iso_utc(time: Column | None = None) -> Column:
    """Time as ISO-8601 text in UTC with six digits and `Z`; the session zone must be UTC."""
    return F.date_format(F.current_timestamp() if time is None else time, ISO_UTC)


def message_key(file_id: Column, now: Column | None = None) -> Column:
    """The id, or `unknown_<epoch ms>` for an empty id."""
    millis = F.unix_millis(F.current_timestamp() if now is None else now)
    return F.when(F.length(file_id) > 0, file_id).otherwise(F.concat(F.lit("unknown_"), millis.cast("string")))


def file_metadata(file_id: Column, name: Column, mime_type: Column) -> Column:
    return F.create_map(
        F.lit("file_id"), file_id, F.lit("file_name"), name, F.lit("mime_type"), mime_type
    )


def metadata_json(metadata: Column) -> Column:
    """JSON object of a metadata map, nulls kept as `null`."""
    return F.to_json(metadata, {"ignoreNullFields": "false"})
