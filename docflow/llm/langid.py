"""Language identification by rank-order n-gram profiles and out-of-place distance."""

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F, types as T

UNDETERMINED = "und"
PROFILE = 300
# A table of so many languages is broadcast at most: a label column with more is no language column.
MAX_LANGUAGES = 10_000
_MAX_GRAMS = 400_000
# So many code points are turned into grams at once: a Python worker takes some 200 bytes for each meanwhile.
_STRETCH = 1 << 17
_EDGE = np.uint32(ord("_"))


@functools.cache
def _classes() -> np.ndarray:
    """Of each code point: 1 a letter, 2 a mark, 0 anything else."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for start in range(0, 0x110000, 0x800):
        if start == 0xD800:  # surrogates
            continue
        some = "".join(map(chr, range(start, start + 0x800)))
        for value, kind in ((1, r"\p{L}+"), (2, r"\p{M}+")):
            for found in regex.finditer(kind, some):
                table[start + found.start() : start + found.end()] = value
    return table


def letter_runs(text: str) -> np.ndarray:
    """The code points of a text, lower-cased, between two "_"; all that is in no run of letters is "_", too.

    A run is a letter with the letters and marks after it.
    """
    points = np.frombuffer(f"_{text.lower()}_".encode("utf-32-le"), dtype=np.uint32)
    kind = _classes()[points]
    inside = kind == 1
    if (kind == 2).any():
        at = np.arange(len(points))
        inside = np.maximum.accumulate(np.where(inside, at, -1)) > np.maximum.accumulate(np.where(kind == 0, at, -1))
    return np.where(inside, points, _EDGE)


def grams(text: str) -> np.ndarray:
    """The 1- to 3-grams of the letter runs of a text, with "_" at both ends of a run, sorted, each as often as it occurs.

    A gram is the number that its code points make at 21 bits each, so numbers order as the grams do by code point.
    """
    points = letter_runs(text)
    inside = np.flatnonzero(points != _EDGE)
    if not len(inside):
        return np.empty(0, dtype=np.int64)
    # Code points that occur get small numbers in the same order, so that most grams fit 32 bits.
    known = np.unique(points)
    digits = len(known) + 1
    small = np.searchsorted(known, points) + 1
    if digits**3 < 1 << 31:
        small = small.astype(np.int32)
    before, own, after = small[inside - 1], small[inside], small[inside + 1]
    first = before == small[0]
    pairs = np.concatenate([own * digits + after, before[first] * digits + own[first]])
    found = np.concatenate([own * digits * digits, pairs * digits, (before * digits + own) * digits + after])
    found.sort()
    points_of = np.concatenate([[0], known.astype(np.int64)])
    found = found.astype(np.int64)
    high, rest = np.divmod(found, digits * digits)
    middle, low = np.divmod(rest, digits)
    return points_of[high] << 42 | points_of[middle] << 21 | points_of[low]


def _counted(sorted_grams: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs, or the sums of their weights."""
    starts = np.flatnonzero(np.concatenate([[True], sorted_grams[1:] != sorted_grams[:-1]])) if len(sorted_grams) else np.empty(0, dtype=np.int64)
    if weights is None:
        return sorted_grams[starts], np.diff(np.append(starts, len(sorted_grams)))
    return sorted_grams[starts], np.add.reduceat(weights, starts) if len(starts) else weights


def _together(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    found, counts = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, dtype=np.int64),) * 2
    order = np.argsort(found, kind="stable")
    return _counted(found[order], counts[order])


def counted_grams(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of texts, sorted, and their counts. Long texts are worked on in stretches that end between runs."""
    parts, held, size, most = [], [], 0, _MAX_GRAMS
    for text in texts:
        for stretch in _stretches(text):
            held.append(stretch)
            size += len(stretch)
            if size >= _STRETCH:
                parts.append(_counted(grams("\n".join(held))))
                held, size = [], 0
                if sum(len(p[0]) for p in parts) > most:
                    parts = [_together(parts)]
                    most = max(_MAX_GRAMS, 2 * len(parts[0][0]))
    if held:
        parts.append(_counted(grams("\n".join(held))))
    return _together(parts)


def _stretches(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + _STRETCH
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end


def gram_counts(texts: DataFrame) -> DataFrame:
    """lang, gram, count over all texts (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            of: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                of.setdefault(lang, []).append(text)
            for lang, some in of.items():
                total[lang] = _together([*([total[lang]] if lang in total else []), counted_grams(some)])
            if sum(len(found) for found, _ in total.values()) > _MAX_GRAMS:
                yield from _rows(total)
                total = {}
        yield from _rows(total)

    found = texts.mapInArrow(run, "lang string, gram long, count long")
    return found.groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def _rows(total: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for lang, (found, counts) in total.items():
        columns = [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "count"])


def profiles(texts: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """The most frequent grams of each language, ties by code point; learned from all texts with a lang.

    Ranked within hash parts of a language first, so that no task sorts all grams of a language.
    """
    counts = gram_counts(texts.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL"))
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(64))).orderBy(F.desc("count"), "gram")
    best = counts.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= size)
    overall = Window.partitionBy("lang").orderBy(F.desc("count"), "gram")
    best = best.withColumn("rank", F.row_number().over(overall)).filter(F.col("rank") <= size)
    rows = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("grams"))
    rows = rows.select("lang", "grams.gram").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {lang: list(found) for lang, found in sorted(rows)}


class Ranker:
    """Ranks a text's grams and compares the ranks with the profiles'."""

    def __init__(self, learned: dict[str, list[int]], size: int):
        self.languages, self.size = list(learned), size
        entries = sorted((gram, column, rank) for column, found in enumerate(learned.values()) for rank, gram in enumerate(found))
        self.gram, self.column, self.rank = np.array(entries, dtype=np.int64).reshape(-1, 3).T

    def top(self, text: str) -> np.ndarray:
        """The most frequent grams, ties by code point."""
        found, counts = counted_grams([text])
        return found[np.argsort(-counts, kind="stable")[: self.size]]

    def closest(self, text: str | None) -> tuple[str, float]:
        """The language with the least out-of-place distance (ties: the first by name), and 1 - distance / largest distance.

        A gram that a profile lacks is out of place by the profile size.
        """
        top = self.top(text or "")
        if not len(top) or not self.languages:
            return UNDETERMINED, 0.0
        low, high = np.searchsorted(self.gram, top, "left"), np.searchsorted(self.gram, top, "right")
        place = np.repeat(np.arange(len(top)), high - low)
        entry = np.arange(len(place)) + np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low)
        away = np.full(len(self.languages), self.size * len(top), dtype=np.int64)
        np.subtract.at(away, self.column[entry], self.size - np.abs(self.rank[entry] - place))
        best = int(np.argmin(away))
        return self.languages[best], float(1 - away[best] / (self.size * len(top)))


def identify(docs: DataFrame, learned: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """Add lang_pred and score (0 to 1) to docs, from whole texts; columns of these names are replaced.

    Null text and text without letters are `und` with score 0, and so is all text if no language was learned.
    """
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(learned, size)
        for batch in batches:
            found = [ranker.closest(text) for text in batch.column("text").to_pylist()]
            columns = [pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return docs.mapInArrow(run, schema)
