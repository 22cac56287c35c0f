"""Checks of text functions, chunking and chunk statistics."""

from pyspark.sql import functions as F

from docflow.checks import inputs as I, sql as S
from docflow.checks.registry import check, filled
from docflow.functions import files as ff, text as ft
from docflow.operators.chunking import chunk_documents, chunk_statistics
from docflow.operators.large_texts import chunk_large_texts, chunk_pieces
from docflow.operators.records import chunk_record
from docflow.schemas import WINDOW_SIZE

DOC = f"WITH {I.DOCUMENTS}"
SOURCE = "SELECT id, text FROM doc"
BOUNDARY = f"WITH RECURSIVE {I.DOCUMENTS}, {S.boundary_chunks(SOURCE)}"
SIMPLE = f"WITH {I.DOCUMENTS}, {S.simple_chunks(SOURCE)}"
CHUNK_COLUMNS = ["id", "chunkIndex", "startPosition", "endPosition", "chunkText", "totalChunks"]


def boundary(spark, sf, keep=("id",)):
    return chunk_documents(I.documents(spark, sf), "id", "text", list(keep))


def simple(spark, sf, keep=("id",)):
    return chunk_documents(I.documents(spark, sf), "id", "text", list(keep), boundaries=False)


# --- text functions ---------------------------------------------------------------------------


def _texts(name, function, sql_function):
    """A text function over the documents as they are and with other white space and control characters in them."""
    sql = f"""{DOC} SELECT id, md5({sql_function('text')}) AS plain, length({sql_function('text')}) AS plain_length,
      md5({sql_function(I.NOISY)}) AS noisy, length({sql_function(I.NOISY)}) AS noisy_length FROM doc"""

    @check(name, sql)
    def query(spark, sf):
        plain, noisy = function(F.col("text")), function(I.noisy())
        docs = I.documents(spark, sf).select("id", plain.alias("plain"), noisy.alias("noisy"))
        return docs.select(
            "id",
            F.md5("plain").alias("plain"),
            F.length("plain").cast("long").alias("plain_length"),
            F.md5("noisy").alias("noisy"),
            F.length("noisy").cast("long").alias("noisy_length"),
        )


_texts("j1_clean_for_chunking", ft.clean_for_chunking, S.clean)
_texts("j2_clean_extracted", ft.clean_extracted, S.extracted)


@check(
    "d5_blank_text_guard",
    f"""WITH w AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN regexp_replace(text, '[^ \\n]', chr(31), 'g') ELSE text END AS t
      FROM conversations) SELECT conv_id, turn, {S.not_blank('t')} AS has_text FROM w""",
)
def d5(spark, sf):
    text = F.when(F.col("role") == "user", F.regexp_replace("text", r"[^ \n]", "\x1f")).otherwise(F.col("text"))
    return I.table(spark, sf, "conversations").select("conv_id", "turn", ft.has_text(text).alias("has_text"))


@check(
    "j3_sentence_boundary",
    rf"""{DOC} SELECT id, CASE WHEN length(regexp_extract(right(text, 100), '(?s)^(.*[.!?\n])', 1)) > 0 THEN
      length(text) - least(length(text), 100) + length(regexp_extract(right(text, 100), '(?s)^(.*[.!?\n])', 1)) ELSE -1 END AS cut
    FROM doc""",
)
def j3(spark, sf):
    return I.documents(spark, sf).select("id", filled(ft.sentence_cut(F.col("text"))).alias("cut"))


@check(
    "j4_word_boundary",
    f"""{DOC} SELECT id, CASE WHEN instr(right(text, 50), ' ') > 0 AND kept > 0 THEN kept ELSE -1 END AS cut FROM (
      SELECT *, length(text) - least(length(text), 50) + length(regexp_extract(right(text, 50), '(?s)^(.*) ', 1)) AS kept
      FROM doc)""",
)
def j4(spark, sf):
    return I.documents(spark, sf).select("id", filled(ft.word_cut(F.col("text"))).alias("cut"))


@check(
    "j5_slice",
    f"{DOC} SELECT id, substring(text, length(text) // 3 + 1, length(text) // 2 - length(text) // 3) AS part FROM doc",
)
def j5(spark, sf):
    n = F.length("text")
    part = ft.slice_text(F.col("text"), F.floor(n / 3).cast("int"), F.floor(n / 2).cast("int"))
    return I.documents(spark, sf).select("id", part.alias("part"))


@check("j7_text_length", f"{DOC} SELECT id, length(text) AS text_length FROM doc")
def j7(spark, sf):
    return I.documents(spark, sf).select("id", ft.text_length(F.col("text")).alias("text_length"))


@check("j8_size_mb", "SELECT page_id, octet_length(encode(html)) / 1048576.0::DOUBLE AS mb FROM pages")
def j8(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", ff.size_mb(F.encode("html", "UTF-8")).alias("mb"))


@check(
    "j15_parse_status",
    f"""WITH d AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN regexp_replace(text, '[^ \\n]+', '', 'g')
      WHEN length(text) >= 40 THEN text END AS t FROM conversations)
    SELECT conv_id, turn, CASE WHEN t IS NULL THEN 'failed' WHEN NOT {S.not_blank('t')} THEN 'empty' ELSE 'success' END
      AS status FROM d""",
)
def j15(spark, sf):
    text = F.when(F.col("role") == "user", F.regexp_replace("text", r"[^ \n]+", "")).when(
        F.length("text") >= 40, F.col("text")
    )
    return I.table(spark, sf, "conversations").select("conv_id", "turn", ft.parse_status(text).alias("status"))


# --- chunking ---------------------------------------------------------------------------------


@check("k1_chunk_boundary", f"{BOUNDARY} SELECT id || '_chunk_' || chunkIndex AS chunkId, {', '.join(CHUNK_COLUMNS)} FROM chunks")
def k1(spark, sf):
    return boundary(spark, sf).select("chunkId", *CHUNK_COLUMNS)


@check(
    "k1_chunk_boundary_small_window",
    f"""WITH RECURSIVE {I.DOCUMENTS}, {S.boundary_chunks(SOURCE, 200, 50)}
    SELECT id, chunkIndex, startPosition, endPosition, md5(chunkText) AS chunk, totalChunks FROM chunks""",
)
def k1_small(spark, sf):
    chunks = chunk_documents(I.documents(spark, sf), "id", "text", ["id"], 200, 50)
    return chunks.select(
        "id", "chunkIndex", "startPosition", "endPosition", F.md5("chunkText").alias("chunk"), "totalChunks"
    )


def as_chunks(rows):
    """Chunks of large texts with the types of the others."""
    longs = ("chunkIndex", "startPosition", "endPosition", "totalChunks")
    return rows.withColumns({c: F.col(c).cast("int") for c in longs}).select("chunkId", *CHUNK_COLUMNS)


BOUNDARY_ROWS = f"{BOUNDARY} SELECT id || '_chunk_' || chunkIndex AS chunkId, {', '.join(CHUNK_COLUMNS)} FROM chunks"


@check("k1_large_texts_ranges_of_500", BOUNDARY_ROWS)
def k1_ranges_500(spark, sf):
    """Ranges shorter than the window: the chain can leap over some."""
    return as_chunks(chunk_large_texts(I.documents(spark, sf), "id", "text", block=500))


@check("k1_large_texts_ranges_of_5000", BOUNDARY_ROWS)
def k1_ranges_5000(spark, sf):
    return as_chunks(chunk_large_texts(I.documents(spark, sf), "id", "text", block=5000))


@check("k1_text_of_all_documents")
def k1_one_text(spark, sf):
    """All documents as the pieces of one text. SQL walks that text chunk by chunk, which is too slow: it is tested against the plain rule."""
    pieces = I.documents(spark, sf).select(F.lit("all").alias("id"), F.col("offset").alias("seq"), "text")
    rows = as_chunks(chunk_pieces(pieces, "id", block=20_000))
    return rows.select("chunkId", "chunkIndex", "startPosition", "endPosition", F.md5("chunkText").alias("chunk"), "totalChunks")


@check(
    "k1b_break_at_boundary",
    f"""{DOC}, w AS (SELECT id, length(text) // 4 AS s, text FROM doc), p AS (
      SELECT id, s, substring(text, s + 1, 300) AS piece FROM w), c AS (SELECT *, {S.cut('piece')} AS kept FROM p)
    SELECT id, left(piece, kept) AS piece, CAST(s + kept AS INTEGER) AS "end" FROM c""",
)
def k1b(spark, sf):
    start = F.floor(F.length("text") / 4).cast("int")
    end = F.least(start + 300, F.length("text"))
    cut = ft.break_at_boundary(F.col("text"), start, end)
    return (
        I.documents(spark, sf).select("id", cut.alias("c")).select("id", F.col("c.text").alias("piece"), F.col("c.end"))
    )


@check("k2_chunk_simple", f"{SIMPLE} SELECT {', '.join(CHUNK_COLUMNS)} FROM chunks")
def k2(spark, sf):
    return simple(spark, sf).select(*CHUNK_COLUMNS)


@check(
    "k3_single_chunk",
    f"""{DOC}, t AS (SELECT id, {S.clean('text')} AS t FROM doc WHERE {S.not_blank('text')})
    SELECT id || '_chunk_0' AS chunkId, t AS chunkText, CAST(0 AS INTEGER) AS startPosition,
      CAST(length(t) AS INTEGER) AS endPosition FROM t WHERE length(t) <= {WINDOW_SIZE}""",
)
def k3(spark, sf):
    single = boundary(spark, sf).filter("totalChunks = 1")
    return single.select("chunkId", "chunkText", "startPosition", "endPosition")


@check("g1_chunk_index", f"{SIMPLE} SELECT id, startPosition, row_number() OVER (PARTITION BY id ORDER BY startPosition) - 1 AS chunkIndex FROM chunks")
def g1(spark, sf):
    return simple(spark, sf).select("id", "startPosition", F.col("chunkIndex").cast("long").alias("chunkIndex"))


@check("g2_total_chunks", f"{SIMPLE} SELECT id, count(*) AS totalChunks FROM chunks GROUP BY id")
def g2(spark, sf):
    chunks = simple(spark, sf).filter("chunkIndex = 0")
    return chunks.select("id", F.col("totalChunks").cast("long").alias("totalChunks"))


@check("j6_chunk_id", f"{SIMPLE} SELECT id || '_chunk_' || chunkIndex AS chunkId FROM chunks")
def j6(spark, sf):
    return simple(spark, sf).select("chunkId")


@check(
    "c3_chunk_record",
    f"""{SIMPLE} SELECT c.id AS fileId, d.name AS fileName, c.id || '_chunk_' || chunkIndex AS chunkId, chunkIndex,
      md5(chunkText) AS chunk, startPosition, endPosition, totalChunks FROM chunks c JOIN doc d USING (id)""",
)
def c3(spark, sf):
    rows = simple(spark, sf, ["id", "name"]).select(chunk_record(F.col("id"), F.col("name")).alias("r"))
    return rows.select("r.*").select(
        "fileId", "fileName", "chunkId", "chunkIndex", F.md5("chunkText").alias("chunk"), "startPosition",
        "endPosition", "totalChunks",
    )


STATISTICS = """count(*) AS total_chunks, CAST(coalesce(sum(length(chunkText)), 0) AS BIGINT) AS total_characters,
  coalesce(avg(length(chunkText)), 0) AS average_chunk_size, CAST(coalesce(min(length(chunkText)), 0) AS INTEGER) AS min_chunk_size,
  CAST(coalesce(max(length(chunkText)), 0) AS INTEGER) AS max_chunk_size"""


@check("f1_chunk_statistics", f"{BOUNDARY} SELECT {STATISTICS} FROM chunks")
def f1(spark, sf):
    return chunk_statistics(boundary(spark, sf))


@check("f1_chunk_statistics_by_file", f"{BOUNDARY} SELECT id, {STATISTICS} FROM chunks GROUP BY id")
def f1_file(spark, sf):
    return chunk_statistics(boundary(spark, sf), ["id"])


@check("f1_chunk_statistics_by_lang", f"{BOUNDARY} SELECT lang, {STATISTICS} FROM chunks JOIN doc USING (id) GROUP BY lang")
def f1_lang(spark, sf):
    return chunk_statistics(boundary(spark, sf, ["lang"]), ["lang"])
