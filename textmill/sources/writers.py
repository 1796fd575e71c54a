"""Writers. Every one is a distributed write of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_records(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Records as JSON lines or Parquet."""
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unsupported record format: {fmt}")
    df.write.mode(mode).format(fmt).save(path)


def write_abstracts(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """(doc_id, text, labels) as records {PubMedID, Abstract, Labels}."""
    named = df.select(F.col("doc_id").cast("string").alias("PubMedID"), F.col("text").alias("Abstract"),
                      F.col("labels").alias("Labels"))
    write_records(named, path, fmt, mode)


def write_corpus(df: DataFrame, path: str, fmt: str, text: str = "sentence", mode: str = "errorifexists") -> None:
    """A corpus as JSON lines or Parquet (all columns), or as text, one `text` per line."""
    if fmt in ("json", "parquet"):
        df.write.mode(mode).format(fmt).save(path)
    elif fmt == "txt":
        # A line break inside a sentence would make two lines of it.
        df.select(F.translate(text, "\r\n", "  ").alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError(f"unsupported corpus format: {fmt}")


def write_metrics(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Metric rows as JSON lines."""
    df.write.mode(mode).json(path)
