"""Text cleaning, boundary search and length functions.

Positions are code points, end-exclusive, as `length` and `substring` count them.
"""

from pyspark.sql import Column, functions as F

from docflow.functions.lets import let
from docflow.schemas import SENTENCE_LOOK_BACK, WORD_LOOK_BACK

# --- fixed values -----------------------------------------------------------------------------

# White space: Unicode white space plus the four separators U+001C-U+001F.
SPACE_RUN = r"(?U)[\s\x1C-\x1F]+"
NOT_SPACE = r"(?U)[^\s\x1C-\x1F]"
# U+0000-U+001F and U+007F. Tab, newlines and separators among them are spaces by the time this is applied.
CONTROL = r"\p{Cntrl}"
SENTENCE_END = r"(?s)^(.*[.!?\n])"
WORD_END = r"(?s)^(.*) "


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, F.lit(SPACE_RUN), F.lit(" "))


def clean_for_chunking(text: Column) -> Column:
    """Collapse white space, then drop control characters, then strip; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(collapse_spaces(text), F.lit(CONTROL), F.lit(""))), F.lit(""))


def clean_extracted(text: Column) -> Column:
    """Collapse white space and strip; control characters stay; null gives ''."""
    return F.coalesce(F.trim(collapse_spaces(text)), F.lit(""))


def has_text(text: Column) -> Column:
    """Some character is not white space. Null and empty text have none."""
    return F.coalesce(text.rlike(NOT_SPACE), F.lit(False))


def text_length(text: Column) -> Column:
    return F.length(text).cast("long")


def slice_text(text: Column, start: Column, end: Column) -> Column:
    """Characters from `start` up to, not including, `end`."""
    return F.substring(text, start + 1, end - start)


def sentence_cut(piece: Column) -> Column:
    """Length of `piece` up to and with its last sentence end in the look-back; null if there is none."""
    return let(
        F.right(piece, F.lit(SENTENCE_LOOK_BACK)),
        lambda tail: let(
            F.length(F.regexp_extract(tail, SENTENCE_END, 1)),
            lambda kept: F.when(kept > 0, F.length(piece) - F.length(tail) + kept),
        ),
    )


def word_cut(piece: Column) -> Column:
    """Length of `piece` before its last space in the look-back; null if none, or if nothing would be left."""
    return let(
        F.right(piece, F.lit(WORD_LOOK_BACK)),
        lambda tail: let(
            F.length(piece) - F.length(tail) + F.length(F.regexp_extract(tail, WORD_END, 1)),
            lambda kept: F.when((F.instr(tail, " ") > 0) & (kept > 0), kept),
        ),
    )


def boundary_cut(piece: Column) -> Column:
    """How much of `piece` a chunk keeps: to a sentence end, else before a space, else all of it."""
    return F.coalesce(sentence_cut(piece), word_cut(piece), F.length(piece))


def break_at_boundary(text: Column, start: Column, end: Column) -> Column:
    """`struct<text, end>` of the piece `[start, end)` cut at its best boundary."""
    return let(
        slice_text(text, start, end),
        lambda piece: let(
            boundary_cut(piece),
            lambda kept: F.struct(
                F.substring(piece, F.lit(1), kept).alias("text"), (start + kept).cast("int").alias("end")
            ),
        ),
    )


def parse_status(text: Column) -> Column:
    """`failed` without a text, `empty` if it has nothing but white space, else `success`."""
    return F.when(text.isNull(), F.lit("failed")).when(~has_text(text), F.lit("empty")).otherwise(F.lit("success"))
