import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()),
     ("size", pa.int64()), ("line", pa.string()), ("node", pa.int64()), ("kept", pa.string()), ("score", pa.string())]
)
LINE = "Every good document says this line in the very same words, and no other."


def edge_documents() -> list[tuple]:
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    long = " ".join(words[(i * i + i // 7) % len(words)] + str(i % 5) for i in range(9000))
    near = " ".join(words * 3)
    rows = [
        (1, None, "en", "b", 0),
        (2, "", "en", "b", 0),
        (3, " \n\t ", None, None, 4),
        (4, "one two", "en", "a", 7),
        (5, "ONE Two", "en", "a", 7),
        (6, long, "en", "a", len(long)),
        (7, long + " tail", "en", None, len(long) + 5),
        (8, near + " one more", "en", "a", None),
        (9, near + " one more word", "en", "a", None),
        (9, near + " one more word", "en", "a", None),
        (10, near + " one more word", "de", "Z", None),
        (11, "12 345 !!", "de", "Z", 9),
        (12, "Über die schöne Straße gehen wir heute nicht mehr 🙂 weiter", "de", "é", 60),
        (13, "one two three four\u00a0five six seven  eight\n\nnine\tten ", "fr", "é", 50),
        (14, "Schreiben schreibens schreiben Schreiber schreiben " * 30 + "écrivains écrivain ÉCRIVAIN" + "aaaaaaaa" * 500, "fr", "é", 50),
        (15, "schreibens écrivains Écrivains schre\u00ffben " * 2 + "aaaaaaaa" * 500 + "a " + "aaaaaaaa" * 500 + "ab", "fr", "é", 50),
        (16, "aaaaaaaa" * 500 + "b schreibe schreibe schriben schriben schrieben " * 2, "fr", None, 50),
        (19, "a <|endoftext|> b <|startoftext|>c", "fr", "é", 34),
        (17, "A b", None, None, 3),
        (18, "a  B", None, None, 4),
        (None, "no id but a text of some six words", "fr", "é", 34),
        (None, LINE, "fr", "é", len(LINE)),
    ]
    rows += [(20 + i, f"Document {i} of {i * i}.\n  {LINE if i % 2 else LINE.upper()} \nEnd {i}.\n{LINE}", "en", "a", None) for i in range(8)]
    return [(*row, 1, "x", 2, "y", "z") for row in rows]


def write(folder: Path, name: str, table: pa.Table) -> None:
    pq.write_table(table, folder / f"{name}.parquet")


def edge_conversations() -> list[tuple]:
    rows = [(c, t, "user" if t % 2 else None, f"turn {t} of {c % 3}") for c in range(40, 60) for t in range(c % 4, 4 + c % 7)]
    rows += [(c, t, "user", "the same in all") for c in (70, 75, 80, 85, 90) for t in range(5)]
    rows += [(c, t, "user", "the same in all") for c in (71, 76) for t in range(12)]
    rows += [(7, None, None, None), (7, None, "user", "é🙂"), (7, 3, "b", "x"), (7, 3, "a", "y"), (7, 3, "a", "y"), (7, -1, "", "")]
    rows += [(None, 1, "user", "of no conversation"), (1, 0, "user", "alone"), (2, 0, "", ""), (3, 0, None, None), (-5, 0, "user", "low"), (-4, 1, "user", "low")]
    rows += [(100, t, "user", "word " * 3000 if t == 40 else str(t)) for t in range(60)] + [(101, t, "user", str(t)) for t in range(60)]
    return [(*row, 1, "x", 2, 3, "y") for row in rows]


def tables(folder: Path, documents: list[tuple], labels: list[tuple], pages: list[tuple], vectors: list[tuple], conversations: list[tuple]) -> str:
    columns = list(zip(*documents)) or [()] * len(DOCUMENTS)
    write(folder, "documents", pa.table([pa.array(c, f.type) for c, f in zip(columns, DOCUMENTS)], schema=DOCUMENTS))
    for name, rows, schema in (
        ("labels", labels, [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]),
        ("pages", pages, [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string())]),
        ("conversations", conversations, [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
          ("depth", pa.int64()), ("path", pa.string()), ("n_convs", pa.int64()), ("row", pa.int64()), ("h1", pa.string())]),
        ("embeddings", vectors, [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("rank", pa.int32())]),
    ):
        columns = list(zip(*rows)) or [()] * len(schema)
        write(folder, name, pa.table([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema]))
    return str(folder)


@pytest.fixture(scope="session")
def edge(tmp_path_factory):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Com", "http://a.com/", "http://a.com/?q#f", "https://x.EXAMPLE.com/en/1?a=b",
        "https://example.com/en", "https://www.example.com/en/x", "https://w.www.example.com/en/x", "https://notexample.com/en/x",
        "https://n.net/es/", "https://n.net/fr/q", "https://n.net/de/q", "https://o.org/fr/q", "https://o.org/en/q", "://h/p://q",
        "https://o.org/" + "long/" * 3000, "https://ü.org/ß", "https://n.net/es/", "https://n.net/es/",
    ]
    vectors = [(i, [float((i * 7 + j * j * (i + 1)) % 11 - 5) for j in range(8)], 1) for i in range(1, 90)]
    vectors += [(100, None, 1), (120, [0.0] * 8, 1), (140, [1.0, None] + [0.0] * 6, 1), (160, [float("nan")] + [1.0] * 7, 1)]
    vectors += [(180, [float("inf")] + [1.0] * 7, 1), (200, [1.0, 2.0], 1), (None, [1.0] * 8, 1), (40, [2.0] * 8, 1), (41, [2.0] * 8, 1)]
    labels = [(4, 1, 0), (4, 1, 1), (6, 0, 0), (8, None, 0), (12, 1, 0), (21, 0, 0), (999, 1, 0), (None, 0, 0)]
    folder = tmp_path_factory.mktemp("edge")
    return tables(folder, edge_documents(), labels, [(i % 20, u, "clash") for i, u in enumerate(urls)], vectors, edge_conversations())


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("empty"), [], [], [], [], [])
