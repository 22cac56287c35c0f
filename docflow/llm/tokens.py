"""Token ids of whole texts by public tokenizers, a chunk at a time.

A text is cut only where the tokenizer's own rule never puts a token across, so the ids of the chunks in a row are the ids
of the text; chunks that come again are not encoded again.
"""

import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from docflow.llm.common import WordTable, texts_as_bytes

# What a text must not hold to be cut at every single space and newline: other white space or two in a row.
_UNEVEN = [b"  ", b" \n", b"\n ", b"\n\n", b"\x00", b"\t", b"\x0b", b"\x0c", b"\r", b"\x1c", b"\x1d", b"\x1e", b"\x1f"]
_UNEVEN += [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]


def _byte_signs() -> dict[int, str]:
    """The sign that byte-level BPE writes for each byte: printable Latin-1 as it is, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    signs = {b: chr(b) for b in plain}
    return signs | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in plain)}


_SIGNS = _byte_signs()


# So many chunks, and up to twice as many, are remembered by a Python worker: about 200 bytes each.
REMEMBERED = 500_000


class Encoder:
    """bytes of a text to its ids as little-endian unsigned 32-bit integers, as the library's default gives them: the literal of an
    added token in a text is that token. Such a text is encoded as a whole."""

    def __init__(self, definition: str, space_parts: bool, remembered: int = REMEMBERED):
        """definition: JSON of the tokenizer. space_parts: white space parts tokens and is dropped (else it belongs to them)."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [token["content"].encode() for token in json.loads(definition).get("added_tokens") or []]
        self.model, self.space_parts = self.tokenizer.model, space_parts
        self.chunks = WordTable(self._encode, remembered)

    def _encode(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        space = "" if self.space_parts else " " * text.startswith(" ")
        signs = text[len(space) :]
        word = signs.rstrip(".,;:!?")
        letters = word.lower() if self.space_parts else word
        if letters.isalpha() and max(letters) < "\u0180":
            # One run of Latin letters is one part for the tokenizer and needs its model only; signs after it are a part of their own.
            found = self.model.tokenize((space + letters).encode().decode("latin-1").translate(_SIGNS))
            ids = b"".join(token.id.to_bytes(4, "little") for token in found)
            return ids + self.chunks[signs[len(word) :].encode()] if len(word) < len(signs) else ids
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def ids(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        if any(x in text for x in self.added):
            return self._encode(text)
        if self.space_parts:
            chunks = text.split()
        elif any(x in text for x in _UNEVEN):
            return self._encode(text)
        else:
            chunks = text.replace(b"\n", b"\x00\n\x00").replace(b" ", b"\x00 ").split(b"\x00")
        return b"".join(map(self.chunks.__getitem__, chunks))


_encoders: dict[tuple[int, bool, int], Encoder] = {}


def encoder(definition: str, space_parts: bool, remembered: int = REMEMBERED) -> Encoder:
    """One encoder per Python worker, tokenizer and number of chunks to remember."""
    key = (hash(definition), space_parts, remembered)
    if key not in _encoders:
        _encoders[key] = Encoder(definition, space_parts, remembered)
    return _encoders[key]


def map_ids(
    docs: DataFrame, tokenizer: str, space_parts: bool, make: Callable[[list, list[bytes | None], Callable], list], schema: T.StructType,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Rows made from the texts of doc_id, text: make(doc_ids, texts, encode) gives the columns of `schema`."""
    definition = Path(tokenizer).read_text()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(definition, space_parts, remembered).ids
        for batch in batches:
            columns = make(batch.column("doc_id").to_pylist(), texts_as_bytes(batch.column("text")), encode)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
