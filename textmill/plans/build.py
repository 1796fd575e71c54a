"""Corpus building: from search hits and articles to labelled sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textmill.operators import corpus as C
from textmill.operators.corpus import KeywordMap
from textmill.runtime import materialize, small_table


def collect_corpus(hits: DataFrame, articles: DataFrame, kwmap: KeywordMap, cap: int = 250,
                   order: list[str] | None = None) -> DataFrame:
    """(doc_id, text, labels): one row per article found, with the labels of its keywords."""
    # Capped hits are few, so the articles are pruned by a broadcast join, not a shuffle.
    labels = small_table(C.labels_per_document(C.cap_per_keyword(hits, cap), kwmap))
    found = C.drop_missing_text(articles).join(labels, "doc_id")
    return C.dedupe_documents(found.select("doc_id", "text", "labels"), "doc_id", order)


def extract_corpus(docs: DataFrame, kwmap: KeywordMap | list[str]) -> DataFrame:
    """(doc_id, sent_idx, sentence): the sentences that mention a keyword."""
    return C.mentions_any(C.sentences(C.drop_missing_text(docs)), kwmap)


def preprocess_corpus(sentences: DataFrame, lexicon: DataFrame | None = None, stop: list[str] | None = None,
                      lemmas: bool = False) -> DataFrame:
    """Add `tokens` and `norm`; empty rows are dropped. With `lemmas` or a lexicon the tokens
    are stored and then lemmatised."""
    out = C.normalize_nonempty(sentences, stop=stop)
    if lexicon is None and not lemmas:
        return out
    return C.lemmatize(materialize(out, "tokens"), lexicon)


def preprocess_counted(docs: DataFrame, stop: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored normalised rows of documents, and (stage, n): documents, those with text, sentences, rows kept.

    The counts are observed while the rows are written, so they cost no pass of their own.
    """
    seen, cut, kept = Observation(), Observation(), Observation()
    docs = docs.observe(seen, F.count("*").alias("documents"), F.count_if(F.col("text") != "").alias("with_text"))
    rows = C.sentences(C.drop_missing_text(docs)).observe(cut, F.count("*").alias("sentences"))
    rows = C.normalize_nonempty(rows, stop=stop).observe(kept, F.count("*").alias("kept"))
    stored = materialize(rows, "normalized")
    counts = [(stage, n) for o in (seen, cut, kept) for stage, n in o.get.items()]
    return stored, docs.sparkSession.createDataFrame(counts, "stage string, n long")


def label_corpus(norm: DataFrame, kwmap: KeywordMap, normalized_keywords: bool = False) -> DataFrame:
    """Add `labels` and `label`."""
    return C.first_label(C.assign_labels(norm, kwmap, normalized_keywords=normalized_keywords))


def labelled_sentences(docs: DataFrame, kwmap: KeywordMap, only_mentions: bool = False) -> DataFrame:
    """Documents to labelled sentences, all in one narrow plan."""
    rows = C.sentences(C.drop_missing_text(docs))
    if only_mentions:
        rows = C.mentions_any(rows, kwmap)
    return label_corpus(preprocess_corpus(rows), kwmap)


def sentences_per_label(docs: DataFrame, kwmap: KeywordMap) -> DataFrame:
    """(label, n)."""
    return C.label_distribution(labelled_sentences(docs, kwmap).select(F.col("label")))
