"""Spelling variants by dense prefix-suffix tiling.

Words that differ by one inserted, deleted or replaced code point have a common prefix and a common suffix that together reach
the longer length minus one. Words are laid out as padded matrices of code points, once from the left and once from the right, and
blocks of such rows are compared pair by pair.

Which blocks meet: of a word cut at one and at two thirds of the longer length n of a pair, one edit leaves two thirds as they are: the
first two, the last two, or the outer ones. A word joins three groups for n its own length and three for n one more. Groups
are cut into tiles, so a crowded group is spread over tasks; a pair counts in one of its groups only.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docflow.llm.common import kept
from docflow.llm.tiling import pairs, tiled, whole_tiles

LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is at least so many times as frequent as its variant.
FORM_RATIO = 10
# One run of every so many, by hash, loses a code point.
THINNED = 31
_CELLS = 1 << 22
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX, SUFFIX, ENDS = range(3)


def letter_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """run: the maximal runs of Latin letters of at least `least` code points in the texts of docs (doc_id, text), A-Z
    lower-cased; one by hash of id and run in THINNED loses a code point. Null texts have none; a null id counts as empty."""
    found = F.regexp_extract_all("text", F.lit(r"([A-Za-zÀ-ÿ]{%d,})" % least), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _UPPER.lower())).otherwise(F.col("run"))
    runs = runs.select("id", lower.alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % THINNED == 0, without).otherwise(F.col("run")).alias("run"))


def words(docs: DataFrame) -> DataFrame:
    """word, n of the words long and frequent enough."""
    counted = letter_runs(docs).filter(F.length("run") >= LEAST_LENGTH).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _groups(found: DataFrame) -> DataFrame:
    """part (longer length times 3 plus side), key, word, n: the six groups of each word."""

    def keys(more: int) -> list[Column]:
        # A third of the longer length. Its two thirds are no longer than the shorter word.
        third = F.floor((F.length("word") + more) / 3).cast("int")
        rest = F.length("word") + more - third
        start, end = F.substring("word", F.lit(1), rest), F.expr("right(word, %s)" % f"cast(length(word) + {more} - floor((length(word) + {more}) / 3) as int)")
        ends = F.concat(F.substring("word", F.lit(1), third), F.lit("\n"), F.expr(f"right(word, cast(floor((length(word) + {more}) / 3) as int))"))
        part = (F.length("word") + more) * 3
        return [F.struct((part + side).cast("long").alias("part"), F.xxhash64(text).alias("key")) for side, text in enumerate((start, end, ends))]

    return found.select("word", "n", F.explode(F.array(*keys(0), *keys(1))).alias("_g")).select("_g.*", "word", "n")


def code_points(words: list[bytes], lengths: np.ndarray, left: bool) -> np.ndarray:
    """Words as rows of a matrix, padded with zeros on the right if they start at the left, else on the left.

    All letters are below U+0100, so a code point is a byte.
    """
    width = int(lengths.max())
    matrix = np.zeros((len(words), width), dtype=np.uint8)
    cells = np.arange(width) < lengths[:, None] if left else np.arange(width) >= width - lengths[:, None]
    matrix[cells] = np.frombuffer(b"".join(words), dtype=np.uint8)
    return matrix


def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many equal cells each row of x and y starts with."""
    differ = x != y
    return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])


def single_edits(table: pa.Table, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows i, j of the pairs of words one edit apart, for the pairs that count in the row's group."""
    part = table.column("part").to_numpy()
    longer, side = part // 3, part % 3
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    lengths = np.array([len(w) for w in words])
    # Groups of one longer length are next to each other only by chance: rows of like width share a matrix.
    for width in np.unique(longer):
        rows = np.flatnonzero(longer == width)
        own = np.full(len(words), -1)
        own[rows] = np.arange(len(rows))
        here = [words[r] for r in rows]
        left, right = (code_points(here, lengths[rows], flag) for flag in (True, False))
        right = right[:, ::-1]
        tiles = np.flatnonzero(longer[starts] == width)
        sub = table.take(rows)
        sub_starts = own[starts[tiles]]
        for i, j in pairs(sub, sub_starts, max(1, min(1 << 18, _CELLS // int(width)))):
            # Two words that are both the shorter kind meet in the groups of their own length.
            at_least_one = (lengths[rows[i]] == width) | (lengths[rows[j]] == width)
            i, j = i[at_least_one], j[at_least_one]
            before = common(left[i], left[j])
            after = common(right[i], right[j])
            third = int(width) // 3
            counts_in = np.where(before >= width - third, PREFIX, np.where(after >= width - third, SUFFIX, ENDS))
            near = (before + after >= width - 1) & (counts_in == side[rows[i]])
            yield rows[i[near]], rows[j[near]]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in whole_tiles(batches, ["part", "key"]):
        n = table.column("n").to_numpy()
        ones, others = [], []
        for i, j in single_edits(table, starts):
            ones += [i, j]
            others += [j, i]
        if not ones or not sum(map(len, ones)):
            continue
        one, other = np.concatenate(ones), np.concatenate(others)
        # Per word of the tile: how many, and the one of largest n, ties to the smallest word.
        texts = np.array(table.column("word").to_pylist(), dtype=object)
        rank = np.empty(len(texts), dtype=np.int64)
        rank[sorted(range(len(texts)), key=lambda r: texts[r])] = np.arange(len(texts))
        order = np.lexsort((rank[other], -n[other], one))
        one, other = one[order], other[order]
        first = np.flatnonzero(np.r_[True, one[1:] != one[:-1]])
        counts = np.diff(np.append(first, len(one)))
        arrays = [
            pa.array(texts[one[first]].tolist(), pa.string()),
            pa.array(counts.astype(np.int64)),
            pa.array(n[other[first]]),
            pa.array(texts[other[first]].tolist(), pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "best_n", "best"])


def near_words(found: DataFrame) -> DataFrame:
    """word, n_near, best, best_n for each word of found (word, n; words differ) that has a word one edit away.

    best is the near word of largest n; ties go to the smallest in code-point order.
    """
    dealt = tiled(_groups(found), ["part", "key"], "word")
    sums = dealt.mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best")))
    sums = sums.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return sums.select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for each row of forms (word, form): the last word that following forms leads to.

    Each round doubles the steps. Counts rise by FORM_RATIO with each step, so 64-bit counts end after five rounds.
    """
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = kept(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if steps.filter("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of docs (doc_id, text).

    form: the near word of largest n (ties: the smallest), if that n is at least FORM_RATIO times the word's own; else null.
    root: the last word reached by following forms; the word itself if it has none. Null or empty texts have no words; repeated
    rows count again; no documents give no rows.
    """
    found = kept(words(docs), "words")
    rows = found.join(near_words(found), "word", "left")
    has_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    rows = kept(
        rows.select(
            "word",
            "n",
            F.when(has_form, F.col("best")).alias("form"),
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(rows.filter("form IS NOT NULL").select("word", "form"))
    rows = rows.join(ends, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
