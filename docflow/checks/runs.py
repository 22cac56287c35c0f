"""Checks of streams, extraction and composite jobs."""

from pyspark.sql import functions as F

from docflow.checks import inputs as I, sql as S
from docflow.checks.registry import check, filled
from docflow.operators.extraction import extract_text, html_pages, utf8_pages
from docflow.operators.records import file_records, from_json_messages, to_json_messages
from docflow.plans.chunk import chunk_report, run_chunk
from docflow.plans.full import run_full
from docflow.plans.listing import run_listing
from docflow.plans.parse import parse_attempts, run_parse
from docflow.schemas import CHUNK_RECORD, FILE_RECORD, PARSED_RECORD
from docflow.session import work_folder
from docflow.sources import store as st, topics as tp
from docflow.sources.files import index, read_bytes, read_paths
from docflow.sources.listing import PAGE_BITS
from docflow.streaming import stages
from docflow.streaming.changes import keep_changed, read_changed
from docflow.streaming.progress import ProgressLog, kept_progress

EV = f"WITH {I.EVENTS}"
LI = f"WITH {I.LISTED}"
PAGE_CAPACITY = 1 << PAGE_BITS
PARTS = 3
PDF = "mimeType IN ('application/pdf', 'application/vnd.google-apps.document')"
HELD = "held AS (SELECT CAST(page_id * 2 AS VARCHAR) AS id, html FROM pages)"
# Attempts on the PDF messages of the change feed: files without bytes fail.
ATTEMPTS = f"""{HELD}, {S.tried(f"SELECT ev.*, html IS NOT NULL AS ok, html FROM ev LEFT JOIN held USING (id) WHERE {PDF}")}"""


def in_parts(spark, sf):
    """The change feed cut into three by arrival."""
    messages = I.file_messages(spark, sf)
    step = messages.agg(F.floor(F.max("offset") / PARTS) + 1).scalar()
    part = F.floor(F.col("offset") / step)
    return [messages.filter(part == i) for i in range(PARTS)]


def streamed_messages(spark, sf, copy):
    """Write the change feed part by part; after each part `copy(topic)` starts a stream and drains it."""
    topic = work_folder(spark, "files-topic")
    for i, part in enumerate(in_parts(spark, sf)):
        tp.write_topic(part, topic, i)
        yield copy(topic)


# --- A, B, L: streams -------------------------------------------------------------------------


@check("a5_topic_scan", f"""{EV} SELECT id AS key, "offset", name, modifiedTime FROM ev""")
def a5(spark, sf):
    topic, copy, checkpoint = (work_folder(spark, n) for n in ("topic", "copy", "checkpoint"))
    tp.write_topic(I.file_messages(spark, sf), topic)
    tp.run_available(tp.copy_stage(spark, topic, FILE_RECORD, copy, checkpoint))
    rows = tp.read_topic(spark, copy, FILE_RECORD)
    return rows.select("key", "offset", "value.name", "value.modifiedTime")


def copied(spark, sf):
    copy, checkpoint = work_folder(spark, "copy"), work_folder(spark, "checkpoint")

    def drain(topic):
        return tp.run_available(tp.copy_stage(spark, topic, FILE_RECORD, copy, checkpoint))

    return copy, list(streamed_messages(spark, sf, drain))


@check("a6_bounded_drain", f"""{EV} SELECT "offset", id AS key, count(*) AS times FROM ev GROUP BY ALL""")
def a6(spark, sf):
    """Three bounded drains of a growing topic, each taking up where the one before ended."""
    copy, _ = copied(spark, sf)
    return tp.read_topic(spark, copy, FILE_RECORD).groupBy("offset", "key").agg(F.count("*").alias("times"))


@check("l5_progress", f"{EV} SELECT count(*) AS input_rows, CAST({PARTS} AS BIGINT) AS runs FROM ev")
def l5(spark, sf):
    _, queries = copied(spark, sf)
    reports = [(i, p["input_rows"]) for i, q in enumerate(queries) for p in stages.progress(q)]
    rows = spark.createDataFrame(reports, "run int, input_rows long")
    return rows.agg(F.sum("input_rows").alias("input_rows"), F.countDistinct("run").alias("runs"))


@check("l5_progress_kept", f"{EV} SELECT count(*) AS input_rows, CAST({PARTS} AS BIGINT) AS runs FROM ev")
def l5_kept(spark, sf):
    """As `l5_progress`, from the log that keeps every micro-batch."""
    log = work_folder(spark, "progress")
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        _, queries = copied(spark, sf)
        late = [q.name or q.runId for q in queries if not listener.wait(q)]
    finally:
        spark.streams.removeListener(listener)
    if late:
        raise TimeoutError(f"progress not written in time: {late}")
    rows = kept_progress(spark, log).filter(F.col("run_id").isin([str(q.runId) for q in queries]))
    return rows.agg(F.sum("input_rows").alias("input_rows"), F.countDistinct("run_id").alias("runs"))


def changed_copy(spark, topic, kept, checkpoint, won, max_batches=None):
    """Drain a topic into the rows that changed, whole batches at a time."""

    def handle(messages, number):
        rows = messages.select("offset", "value.id", "value.modifiedTime", F.expr(won).alias("won"))
        keep_changed(rows, "id", "offset", "modifiedTime", "won", kept, number)

    return tp.run_available(tp.follow(spark, topic, FILE_RECORD, handle, checkpoint, max_batches))


TRIED = S.tried("SELECT *, coalesce(try_cast(size AS BIGINT) < 60, true) AS ok FROM ev")


@check("l1_changed_stream", f"""{EV}, {TRIED} SELECT "offset", id, modifiedTime, ok AS won FROM tried""")
def l1(spark, sf):
    kept, checkpoint = work_folder(spark, "kept"), work_folder(spark, "checkpoint")
    list(streamed_messages(spark, sf, lambda topic: changed_copy(spark, topic, kept, checkpoint, "coalesce(value.size < 60, true)")))
    return read_changed(spark, kept)


@check("l1_changed_stream_many_files", f"""{EV}, {S.tried("SELECT 'all' AS id, \"offset\", modifiedTime, true AS ok FROM ev")} SELECT "offset", modifiedTime FROM tried""")
def l1_files(spark, sf):
    """One key in many files of a batch, a batch at a time: the stream keeps what the rule keeps."""
    topic, kept, checkpoint = (work_folder(spark, n) for n in ("topic", "kept", "checkpoint"))
    rows = I.events(spark, sf).withColumn("id", F.lit("all")).withColumn("size", F.lit(None).cast("string"))
    messages = file_records(rows, ["offset"]).select("key", "offset", "value")
    middle = messages.agg(F.floor(F.max("offset") / 2)).scalar()
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        # Dealt out by hash, so that each file holds offsets from all over.
        tp.write_topic(messages.filter(part).repartition(8, F.xxhash64("offset")), topic)
    changed_copy(spark, topic, kept, checkpoint, "true", 1)
    return read_changed(spark, kept).select("offset", "modifiedTime")


@check(
    "l2_state_moves_on_success",
    f"""{EV}, {S.tried("SELECT *, k < 60 AS ok FROM ev")} SELECT "offset", id, ok AS success FROM tried""",
)
def l2(spark, sf):
    from docflow.operators.changes import mark_changed

    rows = I.events(spark, sf).select("offset", "id", "modifiedTime", (F.col("k") < 60).alias("success"))
    marked = mark_changed(rows, "id", "offset", "modifiedTime", F.col("success"))
    return marked.filter("changed").select("offset", "id", "success")


@check(
    "l3_malformed_value",
    f"""{EV} SELECT "offset", k % 50 = 49 AS rejected, CASE WHEN k % 50 = 49 THEN 'value is malformed' END AS reason,
      CASE WHEN k % 50 <> 49 THEN name END AS name FROM ev""",
)
def l3_malformed(spark, sf):
    """Messages with broken JSON become rejects; the others are read."""
    topic = work_folder(spark, "topic")
    # The size of such events is no number, which the record's rules would reject before: it is taken out.
    rows = file_records(I.events(spark, sf).withColumn("size", F.lit(None).cast("string")), ["offset", "k"])
    text = to_json_messages(rows.select("key", "offset", "k", "value"))
    broken = F.when(F.col("k") % 50 == 49, F.concat(F.lit("{"), "value")).otherwise(F.col("value"))
    tp.write_topic(from_json_messages(text.withColumn("value", broken), FILE_RECORD), topic)
    good = tp.read_topic(spark, topic, FILE_RECORD).select(
        "offset", F.lit(False).alias("rejected"), F.lit(None).cast("string").alias("reason"), "value.name"
    )
    bad = tp.read_rejects(spark, topic, FILE_RECORD)
    return good.union(bad.select("offset", F.lit(True), "reason", F.lit(None).cast("string")))


@check("b3_retry_with_reader", f"""{EV} SELECT "offset", count(*) AS times FROM ev GROUP BY ALL""")
def b3_reader(spark, sf):
    """Each batch is written twice, and a stream reads along: no row comes twice."""
    topic, copy, checkpoint = (work_folder(spark, n) for n in ("topic", "copy", "checkpoint"))
    for i, part in enumerate(in_parts(spark, sf)):
        for _ in range(2):
            tp.write_topic(part, topic, i)
            tp.run_available(tp.copy_stage(spark, topic, FILE_RECORD, copy, checkpoint))
    return tp.read_topic(spark, copy, FILE_RECORD).groupBy("offset").agg(F.count("*").alias("times"))


@check(
    "l3_error_isolation",
    f"""{LI} SELECT "offset", size = 'abc' IS TRUE AS rejected, CASE WHEN size = 'abc' THEN 'size is not a number' END AS reason FROM li""",
)
def l3(spark, sf):
    topic = work_folder(spark, "topic")
    tp.write_topic(file_records(I.listed(spark, sf), ["offset"]), topic)
    good = tp.read_topic(spark, topic, FILE_RECORD).select(
        "offset", F.lit(False).alias("rejected"), F.lit(None).cast("string").alias("reason")
    )
    bad = tp.read_rejects(spark, topic, FILE_RECORD).select("offset", F.lit(True).alias("rejected"), "reason")
    return good.unionByName(bad)


CHAIN = f"""WITH RECURSIVE {I.EVENTS}, {ATTEMPTS},
  parsed AS (SELECT "offset", id, name FROM tried WHERE ok),
  {S.boundary_chunks(f"SELECT id, {S.extracted('html')} AS text FROM held")}"""


@check(
    "l4_stage_chain",
    f"""{CHAIN} SELECT "offset", id || '_chunk_' || chunkIndex AS key, name, startPosition, endPosition, md5(chunkText) AS chunk
    FROM parsed JOIN chunks USING (id)""",
)
def l4(spark, sf):
    """Files, texts, parsed files and chunks as four streams, stopped and started again between parts."""
    parsed, chunks, texts = (work_folder(spark, n) for n in ("parsed", "chunks", "texts"))
    marks = {stage: work_folder(spark, f"checkpoint-{stage}") for stage in ("extract", "parse", "chunk")}
    landed = I.land_files(spark, sf)
    tp.run_available(stages.extract_stage(spark, landed, texts, marks["extract"], utf8_pages, I.landed_id, 1 << 20))

    def drain(topic):
        tp.run_available(stages.parse_stage(spark, topic, texts, parsed, marks["parse"]))
        return tp.run_available(stages.chunk_stage(spark, parsed, texts, chunks, marks["chunk"]))

    list(streamed_messages(spark, sf, drain))
    return chunk_rows(spark, chunks)


@check(
    "l4_late_files",
    f"""{CHAIN} SELECT DISTINCT id, id || '_chunk_' || chunkIndex AS key, startPosition, endPosition, md5(chunkText) AS chunk
    FROM parsed JOIN chunks USING (id)""",
)
def l4_late(spark, sf):
    """All bytes land after all messages, while the streams go on: every file with bytes is parsed and chunked after all."""
    parsed, chunks, texts, topic = (work_folder(spark, n) for n in ("parsed", "chunks", "texts", "topic"))
    marks = {stage: work_folder(spark, f"checkpoint-{stage}") for stage in ("extract", "parse", "chunk")}
    parts = in_parts(spark, sf)

    def drain():
        tp.run_available(stages.parse_stage(spark, topic, texts, parsed, marks["parse"]))
        tp.run_available(stages.chunk_stage(spark, parsed, texts, chunks, marks["chunk"]))

    for part in parts:
        tp.write_topic(part, topic)
    drain()
    landed = I.land_files(spark, sf)
    tp.run_available(stages.extract_stage(spark, landed, texts, marks["extract"], utf8_pages, I.landed_id, 1 << 20))
    tp.write_topic(parts[0].limit(0), topic)  # any further batch, here an empty one
    drain()
    return chunk_rows(spark, chunks).select(
        F.regexp_extract("key", r"^(\d+)_", 1).alias("id"), "key", "startPosition", "endPosition", "chunk"
    ).distinct()


def chunk_rows(spark, topic):
    return tp.read_topic(spark, topic, CHUNK_RECORD).select(
        "offset", "key", F.col("value.fileName").alias("name"), "value.startPosition", "value.endPosition",
        F.md5("value.chunkText").alias("chunk"),
    )


# --- M: extraction ----------------------------------------------------------------------------


@check(
    "m1_extract_utf8",
    f"""SELECT CAST(page_id AS VARCHAR) AS id, 'success' AS status, md5({S.extracted('html')}) AS text,
      length({S.extracted('html')}) AS text_length FROM pages""",
)
def m1(spark, sf):
    pages = I.spread(spark, sf, "pages", "page_id")
    content = pages.select(F.col("page_id").cast("string").alias("id"), F.encode("html", "UTF-8").alias("content"))
    return extract_text(content, utf8_pages).select("id", "status", F.md5("text").alias("text"), "text_length")


@check(
    "m1_extract_failures",
    """SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'failed' WHEN length(text) < 60 THEN 'empty' ELSE 'success' END AS status,
      CASE WHEN role <> 'user' AND length(text) >= 60 THEN length(text) ELSE -1 END AS text_length
    FROM (SELECT * REPLACE (trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text) FROM conversations)""",
)
def m1_failures(spark, sf):
    """Bytes that are no UTF-8 fail, white space is empty."""
    clean = F.trim(F.regexp_replace("text", r"\s+", " "))
    turns = I.table(spark, sf, "conversations").withColumn("text", clean)
    text = F.encode("text", "UTF-8")
    content = F.when(F.col("role") == "user", F.concat(F.unhex(F.lit("FF")), text)).when(
        F.length("text") < 60, F.encode(F.regexp_replace("text", ".", " "), "UTF-8")
    ).otherwise(text)
    rows = turns.select("conv_id", "turn", content.alias("content"))
    return extract_text(rows, utf8_pages).select(
        "conv_id", "turn", "status", filled(F.col("text_length")).alias("text_length")
    )


@check("m1_extract_html")
def m1_html(spark, sf):
    pages = I.spread(spark, sf, "pages", "page_id")
    content = pages.select(F.col("page_id").cast("string").alias("id"), F.encode("html", "UTF-8").alias("content"))
    return extract_text(content, html_pages).select("id", "status", "text", "text_length")


@check(
    "m2_extract_from_paths",
    f"""{EV}, {HELD}, ids AS (SELECT DISTINCT id FROM ev) SELECT id, CASE WHEN html IS NULL THEN 'failed' ELSE 'success' END AS status,
      md5({S.extracted('html')}) AS text FROM ids LEFT JOIN held USING (id)""",
)
def m2(spark, sf):
    """Files of the change feed by path; half of the paths lead to no file."""
    landed = read_bytes(spark, I.land_files(spark, sf), lambda p: F.regexp_extract(p, r"/(id=\d+)\.[^/]*$", 1))
    wanted = I.events(spark, sf).select(F.concat(F.lit("id="), "id").alias("path")).distinct()
    rows = read_paths(wanted, landed.withColumnRenamed("id", "path"))
    id_ = F.substring("path", 4, 100)
    return extract_text(rows, utf8_pages).select(id_.alias("id"), "status", F.md5("text").alias("text"))


# --- N: composite jobs ------------------------------------------------------------------------


@check(
    "n1_listing_to_topic",
    f"""{LI} SELECT page_no * {PAGE_CAPACITY} + pos AS "offset", coalesce(id, '') AS id, coalesce(name, '') AS name,
      coalesce(try_cast(size AS BIGINT), -1) AS size, size IS NOT DISTINCT FROM 'abc' AS rejected
    FROM li WHERE page_no BETWEEN 2 AND 6""",
)
def n1(spark, sf):
    """From a token on, whole pages until 450 files are reached."""
    topic = work_folder(spark, "topic")
    run_listing(spark, I.land_pages(spark, sf), topic, max_files=450, token="t2")
    return listing_result(spark, topic)


def listing_result(spark, topic):
    rows = tp.read_rows(spark, topic, FILE_RECORD)
    return rows.select("offset", "value.id", "value.name", filled(F.col("value.size")).alias("size"), (~F.col("accepted")).alias("rejected"))


@check(
    "n1_listing_report",
    f"""{LI} SELECT count(*) AS processed, count(*) FILTER (size IS DISTINCT FROM 'abc') AS sent,
      count(*) FILTER (size = 'abc') AS failed, 't' || (max(page_no) + 1) AS next_page_token
    FROM li WHERE page_no < (SELECT floor(max(page_no) * 2 / 3) FROM li)""",
)
def n1_report(spark, sf):
    """A run over everything up to an empty page, and what it reports."""
    report = run_listing(spark, I.land_pages(spark, sf, emptied=True), work_folder(spark, "topic"))
    row = [(report["processed"], report["sent"], report["failed"], report["next_page_token"])]
    return spark.createDataFrame(row, "processed long, sent long, failed long, next_page_token string")


@check(
    "n1_listing_stream",
    f"""{LI} SELECT page_no * {PAGE_CAPACITY} + pos AS "offset", coalesce(id, '') AS id, coalesce(name, '') AS name,
      coalesce(try_cast(size AS BIGINT), -1) AS size, size IS NOT DISTINCT FROM 'abc' AS rejected FROM li""",
)
def n1_stream(spark, sf):
    topic, checkpoint = work_folder(spark, "topic"), work_folder(spark, "checkpoint")
    tp.run_available(stages.listing_stage(spark, I.land_pages(spark, sf), topic, checkpoint))
    return listing_result(spark, topic)


def parsed(spark, sf, batches=1):
    """Parse the change feed; returns the folders of the store and the parsed topic."""
    store, topic = work_folder(spark, "store"), work_folder(spark, "parsed")
    feed = in_parts(spark, sf) if batches > 1 else [I.file_messages(spark, sf)]
    for i, messages in enumerate(feed):
        run_parse(spark, messages, I.file_bytes(spark, sf), store, topic, number=i)
    return store, topic


PARSED = f"""{EV}, {ATTEMPTS} SELECT "offset", id AS key, name, modifiedTime, 'parsed/' || id || '.txt' AS storagePath,
  CASE WHEN ok THEN length({S.extracted('html')}) ELSE -1 END AS textLength, CASE WHEN ok THEN 'success' ELSE 'failed' END AS parseStatus
  FROM tried"""


def parsed_rows(spark, topic):
    return tp.read_rows(spark, topic, PARSED_RECORD).select(
        "offset", "key", "value.name", "value.modifiedTime", "value.storagePath",
        filled(F.col("value.textLength")).alias("textLength"), "value.parseStatus",
    )


def file_index(spark, sf):
    """The landed files by path."""
    return index(spark, I.land_files(spark, sf), I.landed_id)


@check("n2_parse_by_path", PARSED)
def n2_paths(spark, sf):
    """The files the messages want are opened by the tasks that extract them."""
    topic = work_folder(spark, "parsed")
    run_parse(spark, I.file_messages(spark, sf), file_index(spark, sf), work_folder(spark, "store"), topic)
    return parsed_rows(spark, topic)


@check("h1_resumed", PARSED)
def h1_resumed(spark, sf):
    """Runs of a few files each that go on from the offset the one before returned; together they are one run."""
    store, topic = work_folder(spark, "store"), work_folder(spark, "parsed")
    messages, content = I.file_messages(spark, sf), file_index(spark, sf)
    most = messages.filter(F.expr(PDF.replace("mimeType", "value.mimeType"))).count() // 4 + 1
    end, runs = -1, 0
    while end is not None:
        end = run_parse(spark, messages.filter(F.col("offset") > end), content, store, topic, max_files=most).end
        runs += 1
    return parsed_rows(spark, topic)


@check("n2_parse", PARSED)
def n2(spark, sf):
    return parsed_rows(spark, parsed(spark, sf)[1])


@check("n2_parse_in_batches", PARSED)
def n2_batches(spark, sf):
    """Three batches, the later ones starting from what the earlier ones parsed."""
    return parsed_rows(spark, parsed(spark, sf, PARTS)[1])


@check(
    "n2_parse_store",
    f"""{EV}, {ATTEMPTS} SELECT 'parsed/' || id || '.txt' AS path, md5({S.extracted('html')}) AS content, name AS file_name, mimeType AS mime_type
    FROM tried WHERE ok QUALIFY row_number() OVER (PARTITION BY id ORDER BY "offset" DESC) = 1""",
)
def n2_store(spark, sf):
    rows = st.read_store(spark, parsed(spark, sf, PARTS)[0])
    return rows.select(
        "path", F.md5("content").alias("content"), F.col("metadata")["file_name"].alias("file_name"),
        F.col("metadata")["mime_type"].alias("mime_type"),
    )


@check("n2_parse_attempts", f"""{EV}, {ATTEMPTS} SELECT "offset", id, ok AS success FROM tried""")
def n2_attempts(spark, sf):
    files = I.events(spark, sf).filter(F.col("mimeType").isin("application/pdf", "application/vnd.google-apps.document"))
    found = I.file_bytes(spark, sf).select("id", F.lit("success").alias("status"), F.lit(0).alias("text_length"))
    attempts = parse_attempts(files.select("offset", "id", "name", "modifiedTime"), found)
    return attempts.select("offset", "id", (F.col("status") == "success").alias("success"))


def chunked(spark, sf):
    """Documents as parsed files, some of them not parsed with success, chunked with the texts of a store."""
    store, topic = work_folder(spark, "store"), work_folder(spark, "chunks")
    st.save(I.store_rows(spark, sf), store, 0)
    docs = I.documents(spark, sf)
    record = F.struct("id", "name", F.concat(F.lit("parsed/"), "id", F.lit(".txt")).alias("storagePath"),
                      F.col("status").alias("parseStatus"))
    run_chunk(spark, docs.select("offset", record.alias("value")), store, topic)
    return topic


N3 = f"WITH RECURSIVE {I.DOCUMENTS}, {S.boundary_chunks('''SELECT id, text FROM doc WHERE status = 'success' ''')}"


@check(
    "n3_chunk",
    f"""{N3} SELECT "offset", id || '_chunk_' || chunkIndex AS key, name, startPosition, endPosition, md5(chunkText) AS chunk
    FROM chunks JOIN doc USING (id)""",
)
def n3(spark, sf):
    return chunk_rows(spark, chunked(spark, sf))


@check(
    "n3_chunk_report",
    f"""{N3} SELECT count(*) AS total_chunks, CAST(sum(length(chunkText)) AS BIGINT) AS total_characters,
      avg(length(chunkText)) AS average_chunk_size, CAST(min(length(chunkText)) AS INTEGER) AS min_chunk_size,
      CAST(max(length(chunkText)) AS INTEGER) AS max_chunk_size FROM chunks""",
)
def n3_report(spark, sf):
    return chunk_report(spark, chunked(spark, sf))


FULL = f"""{CHAIN} SELECT "offset", id || '_chunk_' || chunkIndex AS key, name, startPosition, endPosition, md5(chunkText) AS chunk
  FROM parsed JOIN chunks USING (id)"""


@check("n4_full_run", FULL)
def n4(spark, sf):
    store, topic, chunks = (work_folder(spark, n) for n in ("store", "parsed", "chunks"))
    run_full(spark, I.file_messages(spark, sf), I.file_bytes(spark, sf), store, topic, chunks)
    return chunk_rows(spark, chunks)


@check("n4_full_run_stream", FULL)
def n4_stream(spark, sf):
    """The full run on each micro-batch of a growing topic, stopped and started again between parts."""
    store, topic, chunks, checkpoint = (work_folder(spark, n) for n in ("store", "parsed", "chunks", "checkpoint"))

    def drain(files):
        def content(session):
            return I.file_bytes(session, sf)

        return tp.run_available(stages.full_stage(spark, files, content, store, topic, chunks, checkpoint))

    list(streamed_messages(spark, sf, drain))
    return chunk_rows(spark, chunks)


@check("n4_new_checkpoint", FULL)
def n4_checkpoint(spark, sf):
    """Each part of the topic is read by a stream of its own, with a new checkpoint: none replaces what another wrote."""
    store, topic, chunks = (work_folder(spark, n) for n in ("store", "parsed", "chunks"))
    for part in in_parts(spark, sf):
        files = work_folder(spark, "files-topic")
        tp.write_topic(part, files)
        content = lambda session: I.file_bytes(session, sf)
        tp.run_available(stages.full_stage(spark, files, content, store, topic, chunks, work_folder(spark, "checkpoint")))
    return chunk_rows(spark, chunks)


@check(
    "n1_listing_resumed",
    f"""{LI} SELECT page_no * {PAGE_CAPACITY} + pos AS "offset", coalesce(id, '') AS id, coalesce(name, '') AS name,
      coalesce(try_cast(size AS BIGINT), -1) AS size, size IS NOT DISTINCT FROM 'abc' AS rejected FROM li""",
)
def n1_resumed(spark, sf):
    """Runs that go on from the token of the one before add to the topic; together they are one run."""
    pages, topic = I.land_pages(spark, sf), work_folder(spark, "topic")
    total = I.listed(spark, sf).count()
    token, first = None, True
    while first or token:
        token = run_listing(spark, pages, topic, max_files=total // 3 + 1, token=token)["next_page_token"]
        first = False
    return listing_result(spark, topic)
