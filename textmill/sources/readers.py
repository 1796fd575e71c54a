"""Readers for the file formats of the text pipeline.

A keyword map, a JSON object in one file, is parsed as one row. Arrays of strings or of label lists
are split within a file (see `json_arrays`). An array of records is read by one task per
file; large ones belong in Parquet or JSON lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import markup_text, trim_space
from textmill.schemas import ABSTRACTS
from textmill.sources.json_arrays import array_elements


def _whole(spark: SparkSession, path: str, type_ddl: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", type_ddl, {"mode": "FAILFAST"})
    return files.select(F.col("_metadata.file_path").alias("file"), parsed.alias("parsed"))


def read_keyword_map(spark: SparkSession, path: str) -> DataFrame:
    """(pos, keyword, label) from a JSON object, in file order. Blank keywords, which no text can mention, are left out."""
    pairs = F.posexplode(F.map_entries("parsed")).alias("pos", "e")
    return _whole(spark, path, "map<string,string>").select(pairs).select(
        "pos", F.col("e.key").alias("keyword"), F.col("e.value").alias("label")).where(F.trim("keyword") != "")


def read_documents(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """(doc_id, text, labels) from a JSON array of records, JSON lines or Parquet."""
    if fmt == "json":
        raw = spark.read.schema(ABSTRACTS).json(path, multiLine=True)
    elif fmt == "jsonl":
        raw = spark.read.schema(ABSTRACTS).json(path)
    elif fmt == "parquet":
        raw = spark.read.schema(ABSTRACTS).parquet(path)
    else:
        raise ValueError(f"unsupported document format: {fmt}")
    return raw.select(F.col("PubMedID").alias("doc_id"), F.col("Abstract").alias("text"),
                      F.col("Labels").alias("labels"))


def read_string_array(spark: SparkSession, path: str) -> DataFrame:
    """(file, idx, value) from JSON arrays of strings; `idx` is the place in the file. A large file is
    read by many tasks."""
    return array_elements(spark, path, "string")


def read_label_array(spark: SparkSession, path: str) -> DataFrame:
    """(file, idx, labels) from JSON arrays of string arrays. A large file is read by many tasks."""
    return array_elements(spark, path, "array<string>").withColumnRenamed("value", "labels")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): trimmed, non-blank lines of text files."""
    return clean_lines(spark.read.text(path))


def clean_lines(lines: DataFrame) -> DataFrame:
    return lines.select(trim_space("value").alias("value")).filter("value <> ''")


def read_article_xml(spark: SparkSession, path: str, row_tag: str = "PubmedArticle") -> DataFrame:
    """(doc_id, text) from article records; sections are joined by a space, and records
    without an abstract are left out. Text inside inline markup and CDATA sections stays."""
    # A record is read as its raw text, since a schema would keep one text node per section.
    raw = spark.read.format("text").option("lineSep", f"</{row_tag}>").load(path).select(
        F.regexp_extract("value", rf"(?s)<{row_tag}(?:\s[^>]*)?>(.*)", 1).alias("record"))
    # Cited works further down have ids of their own: the first id is the record's.
    doc_id = F.regexp_extract("record", r"(?s)<PMID(?:\s[^>]*)?>(.*?)</PMID>", 1)
    bodies = F.regexp_extract_all("record", F.lit(r"(?s)<AbstractText(?:\s[^>]*[^/>]|\s*)>(.*?)</AbstractText>"), 1)
    sections = F.transform(bodies, lambda b: trim_space(markup_text(b)))
    return raw.select(F.trim(doc_id).alias("doc_id"), F.array_join(sections, " ").alias("text")).filter(
        (F.col("doc_id") != "") & (F.size(sections) > 0))
