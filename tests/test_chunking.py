"""Chunk rules against a plain statement of the rule and against fixed rows."""

import random

import pytest
from pyspark.sql import functions as F

from docflow.functions.text import break_at_boundary, clean_extracted, clean_for_chunking, has_text
from docflow.operators import large_texts
from docflow.operators.chunking import check_window, chunk_documents, chunk_statistics
from docflow.operators.prefix import earlier

SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]


def rule_clean(text):
    collapsed, run = [], False
    for c in text:
        if c.isspace():
            if not run:
                collapsed.append(" ")
            run = True
        else:
            collapsed.append(c)
            run = False
    return "".join(c for c in collapsed if not (ord(c) < 32 and c not in "\t\n\r") and ord(c) != 127).strip(" ")


def rule_cut(piece):
    ends = [i for i in range(max(0, len(piece) - 100), len(piece)) if piece[i] in ".!?\n"]
    if ends:
        return ends[-1] + 1
    spaces = [i for i in range(max(0, len(piece) - 50), len(piece)) if piece[i] == " "]
    return spaces[-1] if spaces and spaces[-1] > 0 else len(piece)


def rule_chunks(text, window, overlap):
    if not any(not c.isspace() for c in text):
        return []
    t = rule_clean(text)
    if len(t) <= window:
        return [(0, len(t), t)]
    out, p = [], 0
    while p < len(t):
        kept = len(t) - p if p + window >= len(t) else rule_cut(t[p : p + window])
        out.append((p, p + kept, t[p : p + kept]))
        p = p + kept - overlap if kept > overlap else p + kept
    return out


def rule_simple(text, window, overlap):
    t = rule_clean(text)
    if len(t) <= window:
        return [(0, len(t), t)]
    return [(i, min(i + window, len(t)), t[i : i + window]) for i in range(0, len(t), window - overlap)]


def spans_of(spark, texts, window, overlap, boundaries=True):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = [[] for _ in texts]
    rows = chunk_documents(df, "id", "text", window=window, overlap=overlap, boundaries=boundaries).collect()
    for r in sorted(rows, key=lambda r: (r.id, r.chunkIndex)):
        assert r.chunkIndex == len(out[r.id]) and r.chunkId == f"{r.id}_chunk_{r.chunkIndex}"
        out[r.id].append((r.startPosition, r.endPosition, r.chunkText))
    for r in rows:
        assert r.totalChunks == len(out[r.id])
    return out


def random_texts(seed, count):
    rng = random.Random(seed)
    letters = "abcde    \n.!?\U0001f600é\x00\x1c　"
    return [
        "".join(rng.choice(letters if rng.random() < 0.7 else "xyz") for _ in range(rng.randint(0, 900)))
        for _ in range(count)
    ]


SETTINGS = [(10, 0), (10, 9), (50, 10), (60, 59), (120, 30), (200, 50), (300, 299)]


@pytest.mark.parametrize("window,overlap", SETTINGS)
def test_boundary_chunks_equal_the_rule(spark, window, overlap):
    texts = random_texts(window + overlap, 60)
    assert spans_of(spark, texts, window, overlap) == [rule_chunks(t, window, overlap) for t in texts]


@pytest.mark.parametrize("window,overlap", SETTINGS)
def test_simple_chunks_equal_the_rule(spark, window, overlap):
    texts = [t for t in random_texts(window, 40) if any(not c.isspace() for c in t)]
    assert spans_of(spark, texts, window, overlap, False) == [rule_simple(t, window, overlap) for t in texts]


def test_long_document(spark):
    text = " ".join(random_texts(5, 900))
    assert spans_of(spark, [text], 1000, 200) == [rule_chunks(text, 1000, 200)]


def test_whole_documents_equal_the_rule(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()
    texts = [d.text for d in docs]
    assert spans_of(spark, texts, 1000, 200) == [rule_chunks(t, 1000, 200) for t in texts]


def test_fixed_rows(spark):
    def at(text, window, overlap, boundaries=True):
        return [s[:2] for s in spans_of(spark, [text], window, overlap, boundaries)[0]]

    assert at("x" * 2000, 1000, 200) == [(0, 1000), (800, 1800), (1600, 2000), (1800, 2000)]
    assert at("aaaa bbbbbbbbbbbbbbbb", 10, 0) == [(0, 4), (4, 14), (14, 21)]
    assert at("x" * 1800, 1000, 200, False) == [(0, 1000), (800, 1800), (1600, 1800)]
    short = "This is a short text that fits in one chunk."
    assert at(short, 1000, 200) == [(0, len(short))]
    assert spans_of(spark, ["\x00\x01"], 1000, 200) == [[(0, 0, "")]]
    assert spans_of(spark, ["\x00\x01"], 1000, 200, False) == [[(0, 0, "")]]
    long = spans_of(
        spark, ["This is a longer text that will be split into multiple chunks for testing purposes."], 50, 10
    )[0]
    assert len(long) > 1 and long[-1][1] == 83
    assert all(b[0] < a[1] for a, b in zip(long, long[1:]))
    simple = at("This is a test text for simple chunking without boundary preservation.", 50, 10, False)
    assert all(b[0] == a[1] - 10 for a, b in zip(simple, simple[1:]))


def test_blank_text_gives_no_chunks(spark):
    assert spans_of(spark, ["", None, " \n\x1f　"], 100, 10) == [[], [], []]
    assert spans_of(spark, ["", None, " \n\x1f　"], 100, 10, False) == [[], [], []]


def test_parameter_check():
    for window, overlap in [(100, 200), (0, 100), (0, 0), (10, 10)]:
        with pytest.raises(ValueError, match="Overlap must be less than window size"):
            check_window(window, overlap)
    with pytest.raises(ValueError, match="overlap must be non-negative"):
        check_window(1000, -100)
    with pytest.raises(ValueError):
        check_window(-1, -2)


def test_cleaning(spark):
    texts = ["This   has    excessive    spaces", "Text with\x00control\x01characters", "a \x00 b", "a  \x1cb", "", None]
    texts += [f"x{c}{c}y{c}" for c in SPACES] + [f"x{chr(i)}y" for i in range(0x100)] + random_texts(9, 30)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", clean_for_chunking(F.col("t")).alias("c"), clean_extracted(F.col("t")).alias("x")).collect()
    assert rows[0].c == "This has excessive spaces" and rows[2].c == "a  b" and rows[3].c == "a b"
    assert rows[1].c == "Text withcontrolcharacters"
    for r in rows:
        assert r.c == (rule_clean(r.t) if r.t else "")
        assert r.x == (" ".join(r.t.split()) if r.t else "")


def test_has_text(spark):
    texts = [None, "", "x", "\x00"] + SPACES
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(has_text(F.col("t"))).collect()]
    assert got == [bool(t and t.strip()) for t in texts]


def test_break_at_boundary(spark):
    text = "This is a sentence. This is another sentence! And a third one?"
    cases = [(text, 0, 30), (text, 0, 15), (text, 0, 5), ("NoBoundaryHere", 0, 5), ("one\ntwo three", 0, 12)]
    df = spark.createDataFrame(cases, "t string, s int, e int")
    got = [tuple(r[0]) for r in df.select(break_at_boundary(F.col("t"), F.col("s"), F.col("e"))).collect()]
    assert got == [("This is a sentence.", 19), ("This is a", 9), ("This", 4), ("NoBou", 5), ("one\n", 4)]


def test_statistics(spark):
    none = spark.createDataFrame([], "chunkText string")
    assert tuple(chunk_statistics(none).first()) == (0, 0, 0.0, 0, 0)
    some = spark.createDataFrame([("a" * 5,), ("a" * 13,), ("a" * 23,)], "chunkText string")
    assert tuple(chunk_statistics(some).first()) == (3, 41, 41 / 3, 5, 23)


def large_text(rng):
    alphabet = "abc de. f!g\n\t\x00\x01 \x1f\u00a0é🙂"
    words = "".join(rng.choice(alphabet) for _ in range(rng.choice((0, 1, 5, 40, 300, 900))))
    return rng.choice(("", " ", "\x00 \x01", "   ")) + words + rng.choice(("", " ", "\x01  ", "x" * 120))


@pytest.mark.parametrize("window, overlap, block, group", [(10, 0, 3, 2), (40, 7, 50, 3), (150, 30, 64, 256)])
def test_large_texts_equal_the_rule(spark, monkeypatch, window, overlap, block, group):
    monkeypatch.setattr(large_texts, "GROUP", group)
    rng = random.Random(window)
    texts = [large_text(rng) for _ in range(40)] + ["\x00\x01", " \t", "", "y" * 500]
    whole = [(f"t{i}", t) for i, t in enumerate(texts)]
    pieces = []
    for key, text in whole:
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(6)))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        pieces += [(key, 1000 * seq * seq, part) for seq, part in enumerate(parts)]
    rng.shuffle(pieces)
    expected = {(k, i, s, e, t) for k, text in whole for i, (s, e, t) in enumerate(rule_chunks(text, window, overlap))}
    totals = {k: len(rule_chunks(text, window, overlap)) for k, text in whole}
    in_pieces = large_texts.chunk_pieces(spark.createDataFrame(pieces, "id string, seq long, text string"), "id", window, overlap, block)
    as_rows = large_texts.chunk_large_texts(spark.createDataFrame(whole, "id string, text string"), "id", "text", window, overlap, block)
    for found in (in_pieces.collect(), as_rows.collect()):
        assert {(r.id, r.chunkIndex, r.startPosition, r.endPosition, r.chunkText) for r in found} == expected
        assert len(found) == len(expected) and all(r.totalChunks == totals[r.id] and r.chunkId == f"{r.id}_chunk_{r.chunkIndex}" for r in found)


@pytest.mark.parametrize("stretch, window, overlap, block, group", [(7, 10, 0, 3, 2), (150, 40, 7, 50, 2), (1, 150, 30, 64, 3)])
def test_stretches_of_ranges_equal_the_rule(spark, monkeypatch, stretch, window, overlap, block, group):
    monkeypatch.setattr(large_texts, "STRETCH", stretch)
    test_large_texts_equal_the_rule(spark, monkeypatch, window, overlap, block, group)


def test_pieces_that_share_a_place_are_read_range_by_range():
    """As when each range was a row: a range has the parts of all pieces that reach into it, in order."""
    parts = [{"at": at, "text": text} for at, text in ((0, "abcdef"), (0, "abcdef"), (6, "abcdef"), (6, "abcdef"))]
    read = large_texts._readings(None, parts, 0, 4, 8, 12, 2)
    assert read == [(0, 4, "abcdef" * 2), (4, 4, "efef" + "abcd" * 2)]
    assert large_texts._readings("abcdefghij", None, 8, 4, 8, 18, 2) == [(8, 8, "abcdefghij")]


def test_short_ranges_are_not_written_with_a_window_each(spark, monkeypatch):
    tables = {}

    def noted(df, name, *args, **options):
        tables[name] = large_texts_written(df, name, *args, **options)
        return tables[name]

    large_texts_written = large_texts.written
    monkeypatch.setattr(large_texts, "written", noted)
    text = "Some words of a sentence that ends. " * 6000
    rows = large_texts.chunk_large_texts(spark.createDataFrame([("a", text)], "id string, text string"), "id", "text", block=500).collect()
    assert sorted((r.startPosition, r.endPosition, r.chunkText) for r in rows) == rule_chunks(text, 1000, 200)
    held = [t.agg(F.sum(F.length(c))).first()[0] or 0 for t in tables.values() for c, kind in t.dtypes if kind == "string" and c != "id"]
    assert len(text) <= sum(held) < 1.1 * len(text)
    assert tables["range-maps"].count() == 3


def test_text_of_all_documents(spark, sf):
    import hashlib

    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    expected = rule_chunks("".join(d.text for d in docs), 1000, 200)
    found = entry.queries()["k1_text_of_all_documents"](spark, sf).collect()
    assert sorted((r.chunkIndex, r.startPosition, r.endPosition, r.chunk) for r in found) == [
        (i, s, e, hashlib.md5(t.encode()).hexdigest()) for i, (s, e, t) in enumerate(expected)
    ]
    assert {r.totalChunks for r in found} == {len(expected)}


def test_large_texts_without_rows(spark):
    assert large_texts.chunk_pieces(spark.createDataFrame([], "id string, seq long, text string"), "id").collect() == []
    odd = spark.createDataFrame([(None, 1, "a"), ("a", None, "b"), ("c", 1, None)], "id string, seq long, text string")
    assert large_texts.chunk_pieces(odd, "id").collect() == []
    with pytest.raises(ValueError):
        large_texts.chunk_pieces(odd, "id", block=0)


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_earlier_rows(spark, monkeypatch, levels):
    from docflow.operators import prefix

    monkeypatch.setattr(prefix, "RANGE_BITS", 2)
    rng = random.Random(levels)
    rows = [(k, o, rng.choice((None, 1, 5, -3))) for k in "ab" for o in rng.sample(range(-50, 500), 60)]
    frame = spark.createDataFrame(rows, "k string, o long, v long")
    found = earlier(frame, ["k"], "o", {"total": ("sum", F.col("v")), "most": ("max", F.struct("v", "o"))}, levels).collect()
    assert len(found) == len(rows)
    for r in found:
        before = [(v, o) for k, o, v in rows if k == r.k and o < r.o]
        values = [v for v, _ in before if v is not None]
        assert r.total == (sum(values) if values else None)
        most = max(before, key=lambda x: (x[0] is not None, x[0] or 0, x[1]), default=None)
        assert (tuple(r.most) if r.most else None) == most
