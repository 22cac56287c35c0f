"""Record schemas, topic names and other values that are fixed by the data contract."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------

PDF = "application/pdf"
WORKSPACE_PREFIX = "application/vnd.google-apps."
WORKSPACE_DOCUMENT = "application/vnd.google-apps.document"

# Types whose files carry text we extract.
PDF_TYPES = [PDF, WORKSPACE_DOCUMENT]

# Workspace type -> type its content is exported as; other Workspace types export as PDF.
EXPORT_TYPES = {
    "application/vnd.google-apps.document": "application/pdf",
    "application/vnd.google-apps.spreadsheet": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.google-apps.presentation": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/vnd.google-apps.drawing": "image/png",
}

FILES_TOPIC = "drive-files"
PARSED_TOPIC = "drive-files-parsed"
CHUNKS_TOPIC = "drive-files-chunks"

PARSE_STATUSES = ["success", "failed", "skipped"]

WINDOW_SIZE = 1000
OVERLAP = 200
SENTENCE_LOOK_BACK = 100
WORD_LOOK_BACK = 50
PAGE_SIZE = 100

# --- records ----------------------------------------------------------------------------------

OWNERS = T.ArrayType(
    T.StructType([T.StructField("displayName", T.StringType()), T.StructField("emailAddress", T.StringType())])
)

FILE_RECORD = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("mimeType", T.StringType()),
        T.StructField("createdTime", T.StringType()),
        T.StructField("modifiedTime", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("webViewLink", T.StringType()),
        T.StructField("webContentLink", T.StringType()),
        T.StructField("parents", T.ArrayType(T.StringType(), False), False),
        T.StructField("owners", OWNERS, False),
    ]
)

PARSED_RECORD = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("mimeType", T.StringType()),
        T.StructField("modifiedTime", T.StringType()),
        T.StructField("storagePath", T.StringType(), False),
        T.StructField("textLength", T.LongType()),
        T.StructField("parseTimestamp", T.StringType(), False),
        T.StructField("parseStatus", T.StringType(), False),
        T.StructField("errorMessage", T.StringType()),
    ]
)

CHUNK_RECORD = T.StructType(
    [
        T.StructField("fileId", T.StringType(), False),
        T.StructField("fileName", T.StringType(), False),
        T.StructField("chunkId", T.StringType(), False),
        T.StructField("chunkIndex", T.IntegerType(), False),
        T.StructField("chunkText", T.StringType(), False),
        T.StructField("startPosition", T.IntegerType(), False),
        T.StructField("endPosition", T.IntegerType(), False),
        T.StructField("chunkTimestamp", T.StringType(), False),
        T.StructField("totalChunks", T.IntegerType(), False),
    ]
)

# A landed listing page. `page_no` is the landing order; fields a source does not send read as null,
# fields that are not named here are never read. Sources send `size` as a string.
LISTED_FILE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("mimeType", T.StringType()),
        T.StructField("createdTime", T.StringType()),
        T.StructField("modifiedTime", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("webViewLink", T.StringType()),
        T.StructField("webContentLink", T.StringType()),
        T.StructField("parents", T.ArrayType(T.StringType())),
        T.StructField("owners", OWNERS),
    ]
)
LISTING_PAGE = T.StructType(
    [
        T.StructField("page_no", T.LongType()),
        T.StructField("files", T.ArrayType(LISTED_FILE)),
        T.StructField("nextPageToken", T.StringType()),
    ]
)

# Row of the content store. `deleted` marks a path as removed from that version on.
STORE_ROW = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("seq", T.LongType()),
    ]
)


def message_schema(record: T.StructType) -> T.StructType:
    """Rows of a keyed topic whose values follow `record`."""
    return T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("offset", T.LongType()),
            T.StructField("value", record),
        ]
    )
