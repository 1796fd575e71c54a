"""Explicit schemas of the tables and files the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

KEYWORD_MAP = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("label", T.StringType()),
])

ABSTRACTS = T.StructType([
    T.StructField("PubMedID", T.StringType()),
    T.StructField("Abstract", T.StringType()),
    T.StructField("Labels", T.ArrayType(T.StringType())),
])

WEIGHTS = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("idx", T.IntegerType()),
    T.StructField("weight", T.DoubleType()),
])

BIASES = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("bias", T.DoubleType()),
])

LOSSES = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("loss", T.DoubleType()),
])
