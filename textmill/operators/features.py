"""Vocabularies, inverse document frequencies and TF-IDF features.

There are two forms. With a bounded vocabulary the feature pipeline of `tfidf_model`
turns each row's terms into a sparse vector without any shuffle. The long form
(key, idx, weight) is for vocabularies of any size.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.text import term_counts
from textmill.operators.corpus import KEY
from textmill.operators.ranking import rank_within
from textmill.runtime import SMALL_ROWS, materialize, small_table


def term_frequency(df: DataFrame, terms: str = "tokens") -> DataFrame:
    """(term, tf): occurrences of each term."""
    return df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("tf"))


def document_frequency(df: DataFrame, terms: str = "tokens") -> DataFrame:
    """(term, df): rows that hold each term."""
    each = df.select(F.explode(F.array_distinct(terms)).alias("term"))
    return each.groupBy("term").agg(F.count("*").alias("df"))


def term_statistics(df: DataFrame, terms: str = "tokens") -> DataFrame:
    """(term, tf, df) from one pass and one shuffle."""
    each = df.select(F.explode(term_counts(terms)).alias("e")).select("e.term", "e.n")
    return each.groupBy("term").agg(F.sum("n").alias("tf"), F.count("*").alias("df"))


def build_vocabulary(df: DataFrame, terms: str = "tokens", max_features: int | None = 1000) -> DataFrame:
    """(term, idx, tf, df): the most frequent terms, ties in term order.

    Without `max_features` all terms are numbered in the same order, with a 64-bit index: terms of higher
    counts are counted by a histogram, and equal counts are ranked by term, prefix by
    prefix, so that no task ever sorts the whole vocabulary.
    """
    stats = term_statistics(df, terms)
    if max_features is None:
        # Ranking reads the statistics more than once; stored, they cost the corpus one pass only.
        stored = materialize(stats, "terms")
        higher = W.orderBy(F.desc("tf")).rowsBetween(W.unboundedPreceding, -1)
        # One row per distinct count: far fewer than terms.
        above = stored.groupBy("tf").agg(F.count("*").alias("_n")).select(
            "tf", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_above"))
        ranked = rank_within(stored, ["tf"], F.substring("term", 1, 3), [F.col("term")], "_rank")
        idx = (F.col("_above") + F.col("_rank") - 1).cast("bigint")
        return ranked.join(above, "tf").select("term", idx.alias("idx"), "tf", "df")
    order = [F.desc("tf"), F.asc("term")]
    top = stats.orderBy(*order).limit(max_features)
    idx = F.row_number().over(W.orderBy(*order)) - 1
    return top.select("term", idx.alias("idx"), "tf", "df")


def fit_idf(train: DataFrame, vocab: DataFrame, terms: str = "tokens") -> DataFrame:
    """Add `idf` = ln((N + 1) / (df + 1)) + 1, with N and df taken from the training rows."""
    n = train.count()
    if "df" not in vocab.columns:
        seen = document_frequency(train, terms)
        vocab = vocab.join(seen, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    idf = F.log((n + F.lit(1.0)) / (F.col("df") + 1)) + 1
    return vocab.withColumn("idf", idf)


def vocab_lookup(terms: DataFrame, vocab: DataFrame, hot_rows: int = SMALL_ROWS) -> DataFrame:
    """Join rows with a `term` to the vocabulary; terms outside it are dropped.

    A vocabulary of up to `hot_rows` terms is broadcast. Of a larger one the most frequent
    terms are broadcast and only the others are shuffled: none of those can be a hot key.
    """
    by_use = [F.desc("tf"), F.asc("term")] if "tf" in vocab.columns else [F.asc("term")]
    top = vocab.orderBy(*by_use).limit(hot_rows).toArrow()
    hot = F.broadcast(vocab.sparkSession.createDataFrame(top, vocab.schema))
    if top.num_rows < hot_rows:
        return terms.join(hot, "term")
    cold = vocab.join(hot.select("term"), "term", "left_anti")
    rest = terms.join(hot.select("term"), "term", "left_anti")
    return terms.join(hot, "term").unionByName(rest.join(cold, "term"))


def count_vectors(df: DataFrame, vocab: DataFrame, terms: str = "tokens", key: list[str] = KEY) -> DataFrame:
    """Long form (key, idx, n): how often each vocabulary term occurs in a row."""
    each = df.select(*key, F.explode(term_counts(terms)).alias("e")).select(*key, "e.term", "e.n")
    return vocab_lookup(each, vocab).select(*key, "idx", "n")


def tfidf(
    df: DataFrame, vocab: DataFrame, terms: str = "tokens", key: list[str] = KEY, relative: bool = True
) -> DataFrame:
    """Long form (key, idx, weight), not normalised: term frequency times `idf`.

    The frequency is the count over all terms of the row, known or not; with
    `relative=False` it is the plain count.
    """
    each = df.select(*key, F.size(terms).alias("_len"), F.explode(term_counts(terms)).alias("e"))
    found = vocab_lookup(each.select(*key, "_len", "e.term", "e.n"), vocab)
    tf = F.col("n") / F.col("_len") if relative else F.col("n").cast("double")
    return found.select(*key, "idx", (tf * F.col("idf")).alias("weight"))


def l2_normalize(features: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Divide by the row's Euclidean norm; rows of norm 0 are left as they are."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy(*key)))
    return features.withColumn("weight", F.col("weight") / F.when(norm == 0, 1.0).otherwise(norm))


def tfidf_model(vocab: DataFrame, terms: str = "tokens", out: str = "features") -> PipelineModel:
    """Feature pipeline for a vocabulary with `idf`: counts, times idf, L2 normalised.

    Every stage is a projection. The driver holds the vocabulary, as for any ML model;
    dividing by the row length first would make no difference after normalisation.
    """
    rows = vocab.select("idx", "term", "idf").orderBy("idx").collect()
    if not rows:
        raise ValueError("the vocabulary is empty")
    counts = CountVectorizerModel.from_vocabulary([r.term for r in rows], inputCol=terms, outputCol="_counts")
    scaled = ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in rows]), inputCol="_counts",
                                outputCol="_scaled")
    return PipelineModel([counts, scaled, Normalizer(p=2.0, inputCol="_scaled", outputCol=out)])


def tfidf_fit(
    train: DataFrame, terms: str = "tokens", max_features: int = 1000, out: str = "features"
) -> tuple[PipelineModel, DataFrame]:
    """Fit vocabulary and idf on the training rows: (feature pipeline, vocabulary table).

    The pipeline holds its vocabulary on the driver, so the number of terms must be given;
    `tfidf_all_terms` works without.
    """
    if max_features is None:
        raise ValueError("a feature pipeline needs max_features; use tfidf_all_terms for all terms")
    vocab = small_table(build_vocabulary(train, terms, max_features), max_features)
    vocab = fit_idf(train, vocab, terms)
    return tfidf_model(vocab, terms, out), vocab


def tfidf_all_terms(train: DataFrame, df: DataFrame, terms: str = "tokens", key: list[str] = KEY) -> DataFrame:
    """Long form (key, idx, weight), L2 normalised, over all terms of the training rows: nothing is kept on the driver."""
    vocab = materialize(fit_idf(train, build_vocabulary(train, terms, None), terms), "idf")
    return l2_normalize(tfidf(df, vocab, terms, key), key)


def transform(model: PipelineModel, df: DataFrame, out: str = "features") -> DataFrame:
    """Apply a feature pipeline and drop its intermediate columns."""
    return model.transform(df).select(*[c for c in df.columns if c != out], out)


def entries(df: DataFrame, features: str = "features") -> DataFrame:
    """Add `entries`, the non-zero cells of a sparse vector as array of (idx, weight)."""
    raw = F.unwrap_udt(features)
    return df.withColumn("entries", F.arrays_zip(raw["indices"].alias("idx"), raw["values"].alias("weight")))


def to_long(df: DataFrame, features: str = "features", key: list[str] = KEY) -> DataFrame:
    """Sparse vectors to the long form (key, idx, weight)."""
    return entries(df, features).select(*key, F.inline("entries"))


def to_vectors(features: DataFrame, size: int, key: list[str] = KEY) -> DataFrame:
    """Long form to sparse arrays: (key, size, indices, values) with ascending indices."""
    cells = F.array_sort(F.collect_list(F.struct("idx", "weight")))
    grouped = features.groupBy(*key).agg(cells.alias("_cells"))
    return grouped.select(
        *key, F.lit(size).alias("size"), F.col("_cells.idx").alias("indices"),
        F.col("_cells.weight").alias("values"))
