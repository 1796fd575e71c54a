"""Inputs shared by the registered queries: the keyword map and the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.operators import corpus as C
from textmill.plans.build import label_corpus, preprocess_corpus
from textmill.runtime import spread

# Keywords that occur in the test tables, in map order.
KEYWORDS = {
    "eriner thanea": "Boilerplate",
    "thanedble": "Boilerplate",
    "attion": "Attion",
    "apache": "Apache License",
    "mit license": "MIT License",
    "licensed under": "Licensed",
    "all rights": "All Rights",
    "de la": "De La",
    "que la": "Que La",
    "und der": "Und Der",
    "of the": "Of The",
    "esndha reedes": "Esndha",
}
LABELS = list(dict.fromkeys(KEYWORDS.values()))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sentences(C.drop_missing_text(documents(spark, sf_dir)))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess_corpus(sentences(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_corpus(normalized(spark, sf_dir), KEYWORDS)
