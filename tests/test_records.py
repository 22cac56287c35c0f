"""Record building, validation, functions on metadata."""

import datetime

from pyspark.sql import functions as F, types as T

from docflow.functions import files as ff
from docflow.operators import records as rc
from docflow.schemas import FILE_RECORD, LISTED_FILE, PARSED_RECORD

UTC = datetime.timezone.utc


def listed(spark, *files):
    defaults = dict.fromkeys(f.name for f in LISTED_FILE)
    return spark.createDataFrame([tuple({**defaults, **f}.values()) for f in files], LISTED_FILE)


def test_file_record(spark):
    file = {
        "id": "test_file_123", "name": "Test Document.pdf", "mimeType": "application/pdf", "size": "1024000",
        "parents": ["parent_folder_1"], "owners": [("Owner", "owner@example.org")],
    }
    row = rc.file_records(listed(spark, file)).first()
    assert row.key == "test_file_123" and row.valid and row.reason is None
    assert row.value.size == 1024000 and row.value.parents == ["parent_folder_1"] and row.value.owners == []
    kept = rc.file_records(listed(spark, file), keep_owners=True).first()
    assert kept.value.owners[0].displayName == "Owner"
    assert rc.file_records(listed(spark, file)).schema["value"].dataType.names == FILE_RECORD.names


def test_file_without_id(spark):
    now = F.lit(datetime.datetime(2024, 1, 1, tzinfo=UTC))
    row = rc.file_records(listed(spark, {"name": "File without ID", "mimeType": "text/plain"}), now=now).first()
    assert row.key == "unknown_1704067200000" and row.valid
    assert row.value.id == "" and row.value.parents == [] and row.value.size is None
    assert rc.file_records(listed(spark, {"id": ""})).first().key.startswith("unknown_")


def test_null_policy_and_bad_records(spark):
    files = [
        {"id": "a", "name": None, "parents": []}, {"id": None, "name": "b", "parents": []},
        {"id": "c", "name": "c", "parents": None}, {"id": "d", "name": "d", "parents": ["x", None]},
        {"id": "e", "name": "e", "parents": [], "size": "abc"}, {"id": "f", "name": "f", "parents": []},
    ]
    reasons = [r.reason for r in rc.file_records(listed(spark, *files), null_policy="reject").collect()]
    assert reasons == [
        "name is null", "id is null", "parents is null", "parents holds a null", "size is not a number", None,
    ]
    reasons = [r.reason for r in rc.file_records(listed(spark, *files)).collect()]
    assert reasons == [None, None, None, "parents holds a null", "size is not a number", None]


def test_missing_columns_read_as_null(spark):
    row = rc.file_records(spark.createDataFrame([("a",)], "id string")).first()
    assert row.valid and row.value.name == "" and row.value.size is None


def test_size_rules(spark):
    text = spark.createDataFrame([(None,), ("",), ("0",), ("12",), ("abc",), ("1.5",), ("9" * 30,)], "s string")
    rows = text.select(ff.size_to_long(F.col("s")), ff.size_is_bad(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        (None, False), (None, False), (0, False), (12, False), (None, True), (None, True), (None, True),
    ]
    number = spark.createDataFrame([(None,), (0,), (12,)], "s long")
    assert [r[0] for r in number.select(ff.size_to_long(F.col("s"), T.LongType())).collect()] == [None, None, 12]


def test_mime_types(spark):
    doc = "application/vnd.google-apps.document"
    rows = [
        ("application/pdf", True, "application/pdf"), (doc, True, "application/pdf"), ("text/plain", False, "text/plain"),
        ("image/jpeg", False, "image/jpeg"), (None, False, None), ("", False, ""),
        ("application/vnd.google-apps.spreadsheet", False,
         "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
        ("application/vnd.google-apps.presentation", False,
         "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
        ("application/vnd.google-apps.drawing", False, "image/png"),
        ("application/vnd.google-apps.form", False, "application/pdf"),
    ]
    df = spark.createDataFrame(rows, "m string, pdf boolean, export string")
    got = df.select("m", ff.is_pdf(F.col("m")), ff.export_type(F.col("m"))).collect()
    assert [tuple(r) for r in got] == rows


def test_paths_and_sizes(spark):
    stems = [
        ("parsed/a.txt", "a"), (".a", ".a"), ("x.tar.gz", "x.tar"), ("x.", "x."), ("d/x", "x"), ("d.e/x", "x"),
        ("a b+c.pdf", "a b+c"), ("..x", "."), ("d/", "d"),
    ]
    df = spark.createDataFrame(stems, "p string, s string")
    assert [r[0] for r in df.select(ff.path_stem(F.col("p"))).collect()] == [s for _, s in stems]
    sizes = spark.createDataFrame([(bytearray(1048576),), (bytearray(512000),), (bytearray(),)], "c binary")
    assert [r[0] for r in sizes.select(ff.size_mb(F.col("c"))).collect()] == [1.0, 0.48828125, 0.0]
    one = spark.range(1).select(
        ff.chunk_id(F.lit("test_file"), F.lit(0)), ff.storage_path(F.lit("x")),
        ff.iso_utc(F.lit(datetime.datetime(2024, 5, 6, 7, 8, 9, 12, tzinfo=UTC))),
        ff.metadata_json(ff.file_metadata(F.lit("1"), F.lit('a"b'), F.lit(None))),
    ).first()
    assert tuple(one) == (
        "test_file_chunk_0", "parsed/x.txt", "2024-05-06T07:08:09.000012Z",
        '{"file_id":"1","file_name":"a\\"b","mime_type":null}',
    )


def test_counts(spark):
    rows = spark.createDataFrame([(0, True), (0, True), (1, False)], "batch int, valid boolean")
    counts = rc.delivery_counts(rows, ["batch"])
    assert sorted(tuple(r) for r in counts.collect()) == [(0, 2, 0, 2), (1, 0, 1, 1)]
    assert tuple(rc.run_totals(counts).first()) == (3, 2, 1)
    assert tuple(rc.run_totals(counts.filter("batch > 5")).first()) == (0, 0, 0)


def test_json_round_trip(spark):
    records = rc.file_records(listed(spark, {"id": "a", "name": "n", "size": "5", "parents": ["p"]})).select("key", "value")
    text = rc.to_json_messages(records)
    assert '"mimeType":null' in text.first().value
    assert rc.from_json_messages(text, FILE_RECORD).first().value == records.first().value


def test_split_and_parsed_check(spark):
    def record(name, status):
        return rc.parsed_from_text(F.lit("1"), name, F.lit(None), F.lit(None), F.lit("abc"), status=status)

    rows = spark.range(1).select(record(F.lit("n"), F.lit("success")).alias("value"))
    rows = rows.union(spark.range(1).select(record(F.lit("n"), F.lit("empty")).alias("value")))
    good, bad = rc.split_valid(rc.check_parsed(rows))
    assert good.count() == 1 and bad.first().reason == "parseStatus is not allowed"
    value = good.first().value
    assert value.textLength == 3 and value.storagePath == "parsed/1.txt" and value.errorMessage is None
    assert rows.schema["value"].dataType.names == PARSED_RECORD.names


def test_malformed_values_have_a_reason(spark):
    values = ['{"id":"a","name":"b"}', '{{"id":"a"}', "x", None, '{"id":"a","size":"q"}', "[]"]
    rows = rc.from_json_messages(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset long, value string"), FILE_RECORD)
    got = {r.offset: (r.value and r.value.id, r.reason) for r in rows.collect()}
    bad = (None, "value is malformed")
    assert got == {0: ("a", None), 1: bad, 2: bad, 3: (None, None), 4: bad, 5: bad}
