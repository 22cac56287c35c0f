"""Checks of sources, sinks, records, filters, joins, counts, windows and limits."""

from pyspark.sql import functions as F

from docflow.checks import inputs as I, sql as S
from docflow.checks.registry import check, filled
from docflow.functions import files as ff
from docflow.operators import lookups as lk, records as rc
from docflow.operators.changes import changed_rows, latest_per_key
from docflow.operators.extraction import assemble_pages
from docflow.operators.ordering import first_rows, limit_by_pages, number_batches, running_total, until_empty_page
from docflow.plans.parse import limit_successes, parse_attempts
from docflow.schemas import FILE_RECORD
from docflow.session import work_folder
from docflow.sources import listing as ls, store as st, topics as tp
from docflow.sources.files import read_bytes

EV = f"WITH {I.EVENTS}"
LI = f"WITH {I.LISTED}"
DOC = f"WITH {I.DOCUMENTS}"
LISTED = 'id, name, mimeType, createdTime, modifiedTime, size, webViewLink, webContentLink, parents'


def pages(spark, sf, emptied=False):
    return ls.read_pages(spark, I.land_pages(spark, sf, emptied))


def flat(files, *columns):
    """Listed files with the parent list as text."""
    return files.select(*columns, *LISTED.split(", ")[:-1], F.array_join("parents", ",").alias("parents"))


# --- A: sources -------------------------------------------------------------------------------


@check("a1_listing_scan", f"{LI} SELECT page_no, pos, {LISTED}, 1 AS owners FROM li")
def a1(spark, sf):
    files = ls.list_files(pages(spark, sf))
    return flat(files.withColumn("pos", F.col("pos").cast("long")), "page_no", "pos", F.size("owners").cast("int").alias("owners"))


@check("a2_drain_pages", f"""{LI} SELECT row_number() OVER (ORDER BY "offset") - 1 AS ordinal, page_no, name FROM li""")
def a2(spark, sf):
    ordered = running_total(ls.drain(pages(spark, sf)), "offset", name="ordinal")
    return ordered.select("ordinal", "page_no", "name")


@check("a3_resume_from_token", f"{LI} SELECT page_no, pos, name FROM li WHERE page_no >= 5")
def a3(spark, sf):
    rest = ls.list_files(ls.from_token(pages(spark, sf), "t5"))
    return rest.select("page_no", F.col("pos").cast("long").alias("pos"), "name")


@check(
    "a4_file_bytes",
    f"""{EV}, ids AS (SELECT DISTINCT id FROM ev), held AS (SELECT CAST(page_id * 2 AS VARCHAR) AS id, html || chr(10) AS t FROM pages)
    SELECT id, t IS NOT NULL AS found, coalesce(octet_length(encode(t)), -1) AS bytes, md5(t) AS digest
    FROM ids LEFT JOIN held USING (id)""",
)
def a4(spark, sf):
    landed = read_bytes(spark, I.land_files(spark, sf), I.landed_id)
    ids = I.events(spark, sf).select("id").distinct()
    rows = lk.bytes_lookup(ids, landed)
    return rows.select(
        "id", "found", filled(F.octet_length("content")).alias("bytes"), F.md5("content").alias("digest")
    )


@check(
    "a7_content_load",
    f"""{DOC}, {I.WANTED} SELECT w.path, md5(d.text) AS content, d.name IS NOT NULL AS found
    FROM wanted w LEFT JOIN doc d ON w.path = d.path""",
)
def a7(spark, sf):
    store = work_folder(spark, "store")
    st.save(I.store_rows(spark, sf), store, 0)
    rows = st.load(spark, store, I.wanted_paths(spark, sf))
    return rows.select("path", F.md5("content").alias("content"), F.col("content").isNotNull().alias("found"))


# --- B: sinks ---------------------------------------------------------------------------------


@check(
    "b1_keyed_topic_write",
    f"""{EV} SELECT id AS key, count(*) AS messages, CAST(1 AS BIGINT) AS partitions, min("offset") AS first,
      max("offset") AS last FROM ev WHERE size IS DISTINCT FROM 'abc' GROUP BY id""",
)
def b1(spark, sf):
    topic = work_folder(spark, "topic")
    tp.write_topic(rc.file_records(I.events(spark, sf), ["offset"]), topic)
    rows = tp.read_rows(spark, topic, FILE_RECORD).filter("accepted")
    return rows.groupBy("key").agg(
        F.count("*").alias("messages"),
        F.countDistinct("partition").alias("partitions"),
        F.min("offset").alias("first"),
        F.max("offset").alias("last"),
    )


@check(
    "b2_value_serialisation",
    f"""{EV} SELECT id AS key, "offset", id, name, mimeType, createdTime, modifiedTime, coalesce(try_cast(size AS BIGINT), -1) AS size FROM ev""",
)
def b2(spark, sf):
    written = rc.to_json_messages(I.file_messages(spark, sf))
    rows = rc.from_json_messages(written, FILE_RECORD)
    names = ["id", "name", "mimeType", "createdTime", "modifiedTime"]
    size = filled(F.col("value.size")).alias("size")
    return rows.select("key", "offset", *[F.col(f"value.{n}") for n in names], size)


@check("b3_retry_without_doubles", f"""{EV} SELECT "offset", count(*) AS times FROM ev GROUP BY "offset" """)
def b3(spark, sf):
    topic = work_folder(spark, "topic")
    messages = I.file_messages(spark, sf)
    middle = messages.agg(F.floor(F.max("offset") / 2)).scalar()
    tp.write_topic(messages.filter(F.col("offset") <= middle), topic, 0)
    tp.write_topic(messages.filter(F.col("offset") > middle), topic, 1)
    tp.write_topic(messages.filter(F.col("offset") > middle), topic, 1)
    return tp.read_topic(spark, topic, FILE_RECORD).groupBy("offset").agg(F.count("*").alias("times"))


@check(
    "b4_content_save",
    f"""{DOC}, again AS (SELECT 'parsed/' || doc_id || '.txt' AS path, quality FROM labels)
    SELECT path, md5(CASE WHEN quality IS NULL THEN text ELSE name || quality END) AS content,
      CASE WHEN quality IS NULL THEN 0 ELSE 1 END AS version
    FROM doc LEFT JOIN again USING (path)""",
)
def b4(spark, sf):
    store = work_folder(spark, "store")
    st.save(I.store_rows(spark, sf), store, 0)
    changed = I.documents(spark, sf).join(
        I.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality"), "id"
    )
    rows = changed.select(
        ff.storage_path(F.col("id")).alias("path"),
        F.concat("name", "quality").alias("content"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        F.lit(2).alias("seq"),
    )
    earlier = rows.withColumn("content", F.lit("overwritten")).withColumn("seq", F.lit(1))
    st.save(rows.unionByName(earlier), store, 1)
    latest = st.read_store(spark, store)
    return latest.select("path", F.md5("content").alias("content"), F.col("version").cast("int").alias("version"))


METADATA = """'{"file_id":"' || id || '","file_name":"' || name || '","mime_type":' || coalesce('"' || mimeType || '"', 'null') || '}'"""


@check("b5_metadata_table", f"{DOC} SELECT path, {METADATA} AS metadata FROM doc")
def b5(spark, sf):
    store = work_folder(spark, "store")
    st.save(st.content_rows(I.documents(spark, sf)), store, 0)
    return st.read_store(spark, store).select("path", ff.metadata_json(F.col("metadata")).alias("metadata"))


@check(
    "b6_delete_by_path",
    f"""{DOC} SELECT path, length(text) AS size FROM doc
    WHERE path NOT IN (SELECT 'parsed/' || doc_id || '.txt' FROM labels WHERE quality = 0)""",
)
def b6(spark, sf):
    store = work_folder(spark, "store")
    st.save(I.store_rows(spark, sf), store, 0)
    gone = I.table(spark, sf, "labels").filter("quality = 0").select(
        F.explode(
            F.array(
                F.concat(F.lit("parsed/"), "doc_id", F.lit(".txt")), F.concat(F.lit("parsed/never_"), "doc_id")
            )
        ).alias("path")
    )
    st.delete(gone, store, 1)
    return st.read_store(spark, store).select("path", F.length("content").cast("long").alias("size"))


# --- C, D: records and filters ----------------------------------------------------------------


@check(
    "c1_normalise_file",
    f"""{LI} SELECT "offset", coalesce(id, '') AS id, coalesce(name, '') AS name, mimeType, createdTime, modifiedTime,
      coalesce(try_cast(size AS BIGINT), -1) AS size, webViewLink, webContentLink, coalesce(parents, '') AS parents, 0 AS owners,
      size IS DISTINCT FROM 'abc' AS valid FROM li""",
)
def c1(spark, sf):
    rows = rc.file_records(I.listed(spark, sf), ["offset"])
    files = rows.select("offset", "valid", "value.*").withColumn("size", filled(F.col("size")))
    return flat(files, "offset", "valid", F.size("owners").alias("owners"))


@check(
    "c2_parsed_record",
    f"""{DOC} SELECT id, name, mimeType, modifiedTime, path AS storagePath, length(text) AS textLength,
      status AS parseStatus, CAST(NULL AS VARCHAR) AS errorMessage FROM doc""",
)
def c2(spark, sf):
    record = rc.parsed_from_text(
        F.col("id"), F.col("name"), F.col("mimeType"), F.col("modifiedTime"), F.col("text"), status=F.col("status")
    )
    return I.documents(spark, sf).select(record.alias("r")).select("r.*").drop("parseTimestamp")


@check(
    "c4_message_key",
    f"""{LI} SELECT "offset", CASE WHEN id IS NULL THEN 'unknown_' ELSE id END AS key, id IS NULL AS fallback FROM li""",
)
def c4(spark, sf):
    rows = rc.file_records(I.listed(spark, sf), ["offset"])
    key = F.regexp_replace("key", r"^(unknown_)\d+$", "$1")
    return rows.select("offset", key.alias("key"), (F.col("value.id") == "").alias("fallback"))


@check(
    "d1_is_pdf",
    f"""{EV} SELECT "offset", coalesce(mimeType IN ('application/pdf', 'application/vnd.google-apps.document'), false) AS is_pdf FROM ev""",
)
def d1(spark, sf):
    return I.events(spark, sf).select("offset", ff.is_pdf(F.col("mimeType")).alias("is_pdf"))


@check("d2_status_filter", f"{DOC} SELECT id, status FROM doc WHERE status = 'success'")
def d2(spark, sf):
    return lk.with_status(I.documents(spark, sf), column="status").select("id", "status")


@check("d3_has_storage_path", f"{DOC} SELECT id FROM doc WHERE status <> 'failed' AND status <> 'skipped'")
def d3(spark, sf):
    path = F.when(F.col("status") == "failed", None).when(F.col("status") == "skipped", "").otherwise(
        ff.storage_path(F.col("id"))
    )
    return lk.with_path(I.documents(spark, sf).withColumn("storagePath", path)).select("id")


@check("d4_has_content", f"{DOC} SELECT id, length(text) AS size FROM doc WHERE status = 'success'")
def d4(spark, sf):
    content = F.when(F.col("status") == "success", F.col("text")).when(F.col("status") == "skipped", "")
    rows = lk.with_content(I.documents(spark, sf).withColumn("content", content))
    return rows.select("id", F.length("content").cast("long").alias("size"))


@check(
    "d6_record_validation",
    f"""{LI} SELECT "offset", CASE WHEN size = 'abc' THEN 'size is not a number' WHEN id IS NULL THEN 'id is null'
      WHEN name IS NULL THEN 'name is null' WHEN parents IS NULL THEN 'parents is null' END AS reason FROM li""",
)
def d6(spark, sf):
    return rc.file_records(I.listed(spark, sf), ["offset"], "reject").select("offset", "reason")


@check(
    "d6_parsed_validation",
    f"""{DOC} SELECT id, lang <> 'fr' AND status <> 'failed' AS valid,
      CASE WHEN lang = 'fr' THEN 'name is null' WHEN status = 'failed' THEN 'parseStatus is not allowed' END AS reason FROM doc""",
)
def d6_parsed(spark, sf):
    status = F.when(F.col("status") == "failed", "empty").otherwise(F.col("status"))
    name = F.when(F.col("lang") != "fr", F.col("name"))
    record = rc.parsed_from_text(F.col("id"), name, F.col("mimeType"), F.col("modifiedTime"), F.col("text"), status=status)
    checked = rc.check_parsed(I.documents(spark, sf).select("id", record.alias("value")))
    return checked.select("id", "valid", "reason")


# --- E: joins ---------------------------------------------------------------------------------


@check(
    "e1_content_lookup",
    f"""{DOC}, {I.WANTED} SELECT path AS storagePath, md5(text) AS content FROM wanted JOIN doc USING (path) WHERE length(text) > 0""",
)
def e1(spark, sf):
    parsed = I.wanted_paths(spark, sf).withColumnRenamed("path", "storagePath")
    rows = lk.content_lookup(parsed, I.store_rows(spark, sf))
    return rows.select("storagePath", F.md5("content").alias("content"))


HELD = "held AS (SELECT CAST(page_id * 2 AS VARCHAR) AS id, octet_length(encode(html)) AS bytes FROM pages)"


@check(
    "e2_bytes_lookup",
    f"""{EV}, {HELD} SELECT "offset", id, coalesce(bytes, -1) AS bytes, CASE WHEN bytes IS NULL THEN 'failed' ELSE 'found' END AS status
    FROM ev LEFT JOIN held USING (id)""",
)
def e2(spark, sf):
    rows = lk.bytes_lookup(I.events(spark, sf), I.file_bytes(spark, sf))
    status = F.when(F.col("found"), "found").otherwise("failed")
    return rows.select("offset", "id", filled(F.octet_length("content")).alias("bytes"), status.alias("status"))


@check("e3_exists_by_path", f"{DOC}, {I.WANTED} SELECT path FROM wanted WHERE path IN (SELECT path FROM doc)")
def e3(spark, sf):
    return lk.existing(I.wanted_paths(spark, sf), I.store_rows(spark, sf))


@check("e4_not_exists_by_path", f"{DOC}, {I.WANTED} SELECT path FROM wanted WHERE path NOT IN (SELECT path FROM doc)")
def e4(spark, sf):
    return lk.missing(I.wanted_paths(spark, sf), I.store_rows(spark, sf))


# --- F: counts and assembly -------------------------------------------------------------------

COUNTS = "count(*) FILTER (size IS DISTINCT FROM 'abc') AS success, count(*) FILTER (size = 'abc') AS failure, count(*) AS total"


def counts(spark, sf):
    return rc.delivery_counts(rc.file_records(I.listed(spark, sf), ["page_no"]), ["page_no"])


@check("f2_delivery_counts", f"{LI} SELECT page_no, {COUNTS} FROM li GROUP BY page_no")
def f2(spark, sf):
    return counts(spark, sf)


@check(
    "f3_run_totals",
    f"{LI} SELECT count(*) AS processed, count(*) FILTER (size IS DISTINCT FROM 'abc') AS sent, count(*) FILTER (size = 'abc') AS failed FROM li",
)
def f3(spark, sf):
    return rc.run_totals(counts(spark, sf))


@check(
    "f4_page_assembly",
    "SELECT conv_id, string_agg(text || chr(10), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
)
def f4(spark, sf):
    return assemble_pages(I.table(spark, sf, "conversations"), "conv_id", "turn")


# --- G: order-dependent computations ----------------------------------------------------------


@check(
    "g3_changed_since_last",
    f"""{EV}, {S.tried("SELECT *, true AS ok FROM ev")} SELECT "offset", id, modifiedTime FROM tried""",
)
def g3(spark, sf):
    return changed_rows(
        I.events(spark, sf).select("offset", "id", "modifiedTime"), "id", "offset", "modifiedTime"
    )


@check(
    "g3_changed_since_last_in_segments",
    f"""{EV}, {S.tried("SELECT event_type AS id, * EXCLUDE (id), true AS ok FROM ev")} SELECT "offset", id, modifiedTime FROM tried""",
)
def g3_hot(spark, sf):
    """Five keys only, so that all of them are hot and worked on in segments."""
    rows = I.events(spark, sf).select("offset", F.col("event_type").alias("id"), "modifiedTime")
    return changed_rows(rows, "id", "offset", "modifiedTime", segment_rows=100)


@check(
    "g3_changed_since_last_sparse_offsets",
    f"""{EV}, {S.tried("SELECT * REPLACE ('all' AS id), true AS ok FROM ev")} SELECT "offset", modifiedTime FROM tried""",
)
def g3_sparse(spark, sf):
    """One key, with offsets as a listing gives them, few to a page and pages far apart: in segments of 1,000 offsets."""
    spaced = (F.shiftleft("page_no", 20) + F.col("offset") % I.PER_PAGE).alias("at")
    rows = I.events(spark, sf).select("offset", F.lit("all").alias("id"), "modifiedTime", spaced)
    return changed_rows(rows, "id", "at", "modifiedTime", segment_rows=1000).select("offset", "modifiedTime")


@check(
    "g4_latest_per_key",
    f"""{EV} SELECT id, "offset", name FROM ev QUALIFY row_number() OVER (PARTITION BY id ORDER BY "offset" DESC) = 1""",
)
def g4(spark, sf):
    return latest_per_key(I.events(spark, sf), "id", "offset").select("id", "offset", "name")


# --- H, I: limits and unions ------------------------------------------------------------------

PDF_EVENTS = "mimeType IN ('application/pdf', 'application/vnd.google-apps.document')"


@check(
    "h1_limit_by_successes",
    f"""{EV}, {HELD}, {S.tried(f"SELECT ev.*, bytes IS NOT NULL AS ok FROM ev LEFT JOIN held USING (id) WHERE {PDF_EVENTS}")}
    SELECT "offset", id, name FROM tried WHERE ok ORDER BY "offset" LIMIT 10""",
)
def h1(spark, sf):
    files = I.events(spark, sf).filter(ff.is_pdf(F.col("mimeType"))).select("offset", "id", "name", "modifiedTime")
    found = I.file_bytes(spark, sf).select("id", F.lit("success").alias("status"), F.lit(0).alias("text_length"))
    attempts = limit_successes(parse_attempts(files, found), 10)
    return attempts.filter("status = 'success'").select("offset", "id", "name")


@check(
    "h1_limit_in_arrival_order", f"""{EV} SELECT "offset", id FROM ev WHERE {PDF_EVENTS} ORDER BY "offset" LIMIT 10"""
)
def h1_order(spark, sf):
    return first_rows(I.events(spark, sf).filter(ff.is_pdf(F.col("mimeType"))), "offset", 10).select("offset", "id")


@check(
    "h2_limit_by_pages",
    f"""{EV}, paged AS (SELECT "offset", page_no // (1 + page_no % 3) AS page FROM ev),
    sizes AS (SELECT page, count(*) AS n FROM paged GROUP BY page),
    sums AS (SELECT page, sum(n) OVER (ORDER BY page) - n AS before FROM sizes)
    SELECT "offset", page FROM paged JOIN sums USING (page) WHERE before < (SELECT count(*) // 2 FROM ev)""",
)
def h2(spark, sf):
    """Half of the events on pages of uneven length."""
    page = F.floor(F.col("page_no") / (1 + F.col("page_no") % 3)).alias("page")
    paged = I.events(spark, sf).select("offset", page)
    return limit_by_pages(paged, "page", paged.count() // 2)


@check(
    "h3_batches",
    f"""{EV} SELECT "offset", (row_number() OVER (ORDER BY "offset") - 1) // 64 AS batch FROM ev""",
)
def h3(spark, sf):
    return number_batches(I.events(spark, sf).select("offset"), "offset", 64)


@check(
    "h4_stop_at_empty_page",
    f"{LI} SELECT page_no, pos, name FROM li WHERE page_no < (SELECT floor(max(page_no) * 2 / 3) FROM li)",
)
def h4(spark, sf):
    files = ls.list_files(until_empty_page(pages(spark, sf, emptied=True)))
    return files.select("page_no", F.col("pos").cast("long").alias("pos"), "name")


@check(
    "i1_union_all",
    f"""{LI} SELECT 'first' AS part, page_no, name FROM li WHERE page_no < 5 UNION ALL
    SELECT 'rest', page_no, name FROM li WHERE page_no >= 5 UNION ALL SELECT 'rest', page_no, name FROM li WHERE page_no >= 5""",
)
def i1(spark, sf):
    landed = pages(spark, sf)
    first = ls.list_files(landed.filter("page_no < 5")).select(F.lit("first").alias("part"), "page_no", "name")
    rest = ls.list_files(ls.from_token(landed, "t5")).select(F.lit("rest").alias("part"), "page_no", "name")
    return first.unionByName(rest).unionByName(rest)


# --- J: functions on file metadata ------------------------------------------------------------


@check("j9_iso_utc", f"""{EV} SELECT "offset", true AS is_iso FROM ev""")
def j9(spark, sf):
    iso = ff.iso_utc().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z$")
    return I.events(spark, sf).select("offset", iso.alias("is_iso"))


@check("j10_size_to_long", f"""{EV} SELECT "offset", coalesce(try_cast(size AS BIGINT), -1) AS size, coalesce(size = 'abc', false) AS bad FROM ev""")
def j10(spark, sf):
    return I.events(spark, sf).select(
        "offset", filled(ff.size_to_long(F.col("size"))).alias("size"), ff.size_is_bad(F.col("size")).alias("bad")
    )


@check("j11_workspace_type", f"""{EV} SELECT "offset", coalesce(starts_with(mimeType, 'application/vnd.google-apps.'), false) AS workspace FROM ev""")
def j11(spark, sf):
    return I.events(spark, sf).select("offset", ff.is_workspace_type(F.col("mimeType")).alias("workspace"))


@check(
    "j12_export_type",
    f"""{EV}, m AS (SELECT "offset", CASE WHEN k > 90 THEN 'application/vnd.google-apps.form' WHEN k > 80 THEN
      'application/vnd.google-apps.presentation' WHEN k > 70 THEN 'application/vnd.google-apps.drawing' ELSE mimeType END AS mime FROM ev)
    SELECT "offset", CASE mime WHEN 'application/vnd.google-apps.document' THEN 'application/pdf'
      WHEN 'application/vnd.google-apps.spreadsheet' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
      WHEN 'application/vnd.google-apps.presentation' THEN 'application/vnd.openxmlformats-officedocument.presentationml.presentation'
      WHEN 'application/vnd.google-apps.drawing' THEN 'image/png' WHEN 'application/vnd.google-apps.form' THEN 'application/pdf'
      ELSE mime END AS export FROM m""",
)
def j12(spark, sf):
    k = F.col("k")
    mime = (
        F.when(k > 90, "application/vnd.google-apps.form")
        .when(k > 80, "application/vnd.google-apps.presentation")
        .when(k > 70, "application/vnd.google-apps.drawing")
        .otherwise(F.col("mimeType"))
    )
    return I.events(spark, sf).select("offset", ff.export_type(mime).alias("export"))


@check("j13_storage_path", f"{DOC} SELECT id, path FROM doc")
def j13(spark, sf):
    return I.documents(spark, sf).select("id", ff.storage_path(F.col("id")).alias("path"))


@check(
    "j14_path_stem",
    """WITH p AS (SELECT page_id, regexp_extract(url, '([^/]+)/*$', 1) AS name FROM pages)
    SELECT page_id, CASE WHEN regexp_matches(name, '.\\.[^.]+$') THEN regexp_replace(name, '\\.[^.]+$', '') ELSE name END AS stem FROM p""",
)
def j14(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", ff.path_stem(F.col("url")).alias("stem"))


@check("j16_metadata_json", f"{EV} SELECT \"offset\", {METADATA} AS metadata FROM ev")
def j16(spark, sf):
    metadata = ff.file_metadata(F.col("id"), F.col("name"), F.col("mimeType"))
    return I.events(spark, sf).select("offset", ff.metadata_json(metadata).alias("metadata"))
