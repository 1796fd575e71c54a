"""A corpus from raw documents to packed sequences, in four stages.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is
stored before the next one reads it. An empty table passes through all of them. Other columns than
doc_id, text, source and n_chars are carried along as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textmill.llm import jaccard, linededup, packing, quality
from textmill.runtime import materialize

# Encoded words that a Python worker remembers: fewer than in a job of its own, since the executors
# of earlier stages keep their memory.
CACHE_WORDS = 300_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on their text and on their host. Null, empty and very short texts go;
    documents without a source are judged by their text alone; repeated rows are judged one by one."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them hold. Every document stays, if only with an empty
    text; repeated rows count as documents."""
    return linededup.drop_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, null last, and of several texts under it
    the one with the smallest hash. Documents without words are in no group and stay."""
    return jaccard.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 2048 tokens. A null or empty text is one piece
    of its end id; repeated rows are packed one by one."""
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"), cache_words=CACHE_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

# Token ids cannot be made in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
