"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import (htmltext, jaccard, lexical, licenses, linededup, neighbours, packing, pieces, quality,
                          sharding, spelling, suffixdedup, tokencounts)
from textmill.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

# Texts of more tokens are over the limit.
MAX_TOKENS = 512


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether they decode to it (a mark in a text decodes to a blank)."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents")
    coded = pieces.decode(pieces.encode(docs, path, keep=["doc_id", "text"]), path, out="decoded")
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", same.alias("round_trip"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(read(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("bigint"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencounts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.suffix_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(read(spark, sf_dir, "documents"), slip_every=97)
    return spelling.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_extraction": op5_html_extraction,
    "op6_sharding": op6_sharding,
    "op7_license_scan": op7_license_scan,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_token_counts": op9_token_counts,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lexical_search": op13_lexical_search,
}
