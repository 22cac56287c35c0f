"""The operators as stages of a corpus pipeline: documents in, documents out, with all their columns.

Columns of documents that are named like a column an operator works with are set aside meanwhile.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, Window, functions as F

from docflow.llm import langid, line_dedup, mixing, ngram_join, packing
from docflow.llm.common import fold, kept, text_or_empty

# Texts whose grams are so far from every profile are in no learned language.
LEAST_LANGUAGE_SCORE = 0.1
# Chunks of text that a Python worker remembers: it is shared with the other stages, and keeps them.
REMEMBERED = 100_000


def beside(docs: DataFrame, work: Callable[[DataFrame], DataFrame], *names: str) -> DataFrame:
    """work(docs) with the columns of docs that have one of `names` set aside, and the columns of docs again."""
    aside = {name: f"_aside_{i}" for i, name in enumerate(docs.columns) if name.lower() in names}
    done = work(docs.withColumnsRenamed(aside))
    return done.withColumnsRenamed({v: k for k, v in aside.items() if k not in done.columns} if aside else {}).select(docs.columns)


def in_a_language(docs: DataFrame) -> DataFrame:
    """Documents whose text is in one of the languages that the labelled documents outside the held-out fold are in.

    Null texts, texts without letters and texts unlike all profiles go. Without any language label all go.
    """
    learned = langid.profiles(docs.filter(fold("doc_id", 3) != 1))

    def work(rows: DataFrame) -> DataFrame:
        found = langid.identify(rows, learned)
        accepted = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
        return found.filter(accepted).drop("lang_pred", "score")

    return beside(docs, work, "lang_pred", "score")


def without_common_lines(docs: DataFrame) -> DataFrame:
    """Documents without the lines that many documents share; n_chars follows the text. A document may be left empty."""

    def work(rows: DataFrame) -> DataFrame:
        rows = line_dedup.drop_lines(rows)
        changed = F.col("n_dropped") > 0
        rows = rows.withColumn("text", F.when(changed, F.col("kept")).otherwise(F.col("text")))
        if "n_chars" in rows.columns:
            length = F.length("text").cast(rows.schema["n_chars"].dataType)
            rows = rows.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
        return rows.drop("n_lines", "n_dropped", "kept")

    return beside(docs, work, "n_lines", "n_dropped", "kept", "doc", "same", "lines", "drops", "row")


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id (a null id comes last), one row of repeated ones.

    Texts without words are near copies of nothing and stay.
    """
    classes = ngram_join.text_classes(docs.select("doc_id", "text"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "same")
    kept_one = classes.filter("class IS NOT NULL").groupBy("class").agg(F.min(rank).alias("r")).select(
        F.col("r.doc_id").alias("_id"), F.col("r.same").alias("_same"), F.lit(True).alias("_single")
    )
    lone = classes.filter("class IS NULL").select(F.col("doc_id").alias("_id"), F.col("same").alias("_same"), F.lit(False).alias("_single"))
    stay = kept(kept_one.union(lone.distinct()), "stay")

    def work(rows: DataFrame) -> DataFrame:
        own = rows.withColumn("_text", F.xxhash64(text_or_empty()))
        found = own.join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_same")))
        number = F.row_number().over(Window.partitionBy("_id", "_same").orderBy(F.lit(0)))
        return found.withColumn("_number", number).filter("_number = 1 OR NOT _single").drop("_id", "_same", "_single", "_text", "_number")

    return beside(docs, work, "_id", "_same", "_single", "_text", "_number")


def mixed(docs: DataFrame) -> DataFrame:
    """Documents as often as a mix of their sources by weights 1, 2, 3, repeating, takes them."""

    def work(rows: DataFrame) -> DataFrame:
        sized = rows.withColumn("size", mixing.word_count())
        others = [c for c in rows.columns if c not in ("doc_id", "source")]
        taken = mixing.mix(sized, mixing.cycled_weights(sized), keep=others)
        return taken.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies")))

    names = ("size", "draw", "rank", "source_size", "target", "copies", "taken", "whole", "rest", "_copy", "_name", "_slice", "_second")
    return beside(docs, work, *names, "_left", "_side", "_source", "_first")


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of the documents and their places in sequences; see packing.pack."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED)
