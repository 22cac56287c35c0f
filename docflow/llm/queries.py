"""The registered queries: each applies one operator, with production parameters, to its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import ann, fingerprints, langid, line_dedup, mixing, ngram_join, packing, prefix_trie, quality, simhash, spelling, sql, token_files, url_filter
from docflow.llm.common import fold, table
from docflow.llm.registry import query


@query("op1_ngram_jaccard_join", sql.JACCARD)
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def learned_languages(spark: SparkSession, sf_dir: str) -> dict[str, list[int]]:
    """Profiles of the documents outside the held-out fold."""
    return langid.profiles(table(spark, sf_dir, "documents").filter(fold("doc_id", 3) != 1))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text")
    return langid.identify(docs, learned_languages(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


@query("op6_mix_sources", sql.MIX)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("size"))
    mixed = mixing.mix(docs, mixing.cycled_weights(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op8_line_dedup", sql.LINES)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = token_files.round_trip(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_following(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(fold("doc_id", 5) != 0)
    scored = quality.score(docs, quality.learn(docs, labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


@query("op4_url_filters", sql.URLS)
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op13_spelling_variants", sql.SPELLING)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_simhash_near_dedup")
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_conversation_prefix_trie", sql.TRIE)
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
