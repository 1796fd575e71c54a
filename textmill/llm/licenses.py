"""License scans: MinHash bands over overlapping windows find templates, shingle containment confirms them.

Words are runs of a-z and 0-9 after lower-casing A-Z, so line breaks, comment signs and punctuation
do not matter. A template of n words is looked for in windows of 2n words that begin at every
n-th word: each passage of up to n + 1 words lies whole in one of them. A template is found
in a text if one of the windows holds at least 75 % of its distinct five-word shingles.

1. *Windows.* Windows that hold no shingle of any template of their length have similarity 0 to all of them
   and are left out at once; the others are stored.
2. *Bands.* A window that contains a template has a Jaccard similarity to it of at least
   j = m / (s + 2n - 4 - m), for s shingles of which m must be found. Bands have one row, since j is low,
   and there are enough of them that (1 - j)^bands <= `MISS` for the shortest template of each length.
   Windows and templates with an equal band are candidates.
3. *Containment.* The shingles of candidates are intersected.

Everything is a Spark expression or a join with the broadcast templates (a parameter: some hundred short
texts). Texts are not shuffled; only confirmed finds are, combined before the shuffle. Null texts and texts
of fewer than five words hold nothing, as do templates of fewer than five words. Repeated rows
are scanned one by one, null ids like others. Ties: of several windows the first names the place. An empty
table, or no templates, gives an empty result.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import SHINGLE, let, window_hashes
from textmill.runtime import materialize

PERCENT = 75
# The probability at most that a contained template shares no band with its window.
MISS = 1e-6

# Short notices and the openings of well-known license texts.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0 notice": "Unless required by applicable law or agreed to in writing, software distributed under the "
                         "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                         "either express or implied.",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files (the \"Software\"), to deal in the Software without "
                      "restriction",
    "BSD conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                      "provided that the following conditions are met",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
}


def license_words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, "[^a-z0-9]+"), "")


def needed(shingles: int) -> int:
    """Shingles of a template that a window must hold."""
    return ceil(PERCENT * shingles / 100)


def bands(n_words: int, shingles: int, miss: float = MISS) -> int:
    """Bands of one row that leave a contained template without a common one with probability `miss` at most."""
    m = needed(shingles)
    j = m / (shingles + 2 * n_words - SHINGLE + 1 - m)
    return 1 if j >= 1 else ceil(log(miss) / log(1 - j))


def signature(shingles: Column, n: Column) -> Column:
    """The smallest value of each of `n` hash functions over a set of shingles."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.array_min(
        F.transform(shingles, lambda h: F.xxhash64(h, k))))


def template_table(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """`template, words, shingles` of the templates that have shingles."""
    given = docs.sparkSession.createDataFrame(list(templates.items()), "template string, body string")
    w = license_words(F.col("body"))
    return (given.select("template", F.size(w).alias("words"), F.array_distinct(window_hashes(w)).alias("shingles"))
            .where(F.size("shingles") > 0))


def windows(docs: DataFrame, text: str, keep: list[str], sets: dict[int, list[int]]) -> DataFrame:
    """`row, words, start, held` of every window that holds a shingle of a template of its length.

    `sets`: number of words to the shingles of all templates of that length.
    """
    known = sorted({h for s in sets.values() for h in s})

    def of_length(h: Column, n: int) -> Column:
        places = F.filter(F.transform(h, lambda x, i: F.when(x.isin(sets[n]), i)), lambda i: i.isNotNull())
        # The one or two windows around each of these shingles.
        starts = F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(
            F.greatest(F.lit(0), F.ceil((i + SHINGLE - 2 * n) / n).cast("int")), F.floor(i / n).cast("int")))))
        return F.transform(starts, lambda k: F.struct(
            F.lit(n).alias("words"), (k * n).alias("start"),
            F.array_distinct(F.slice(h, k * n + 1, F.lit(2 * n - SHINGLE + 1))).alias("held")))

    # The array of one struct is exploded so that shingles are hashed once, not once per use.
    hashed = docs.select(F.struct(*keep).alias("row"), F.explode(F.array(F.struct(
        window_hashes(license_words(F.col(text))).alias("h")))).alias("_t"))
    hit = hashed.where(F.exists("_t.h", lambda x: x.isin(known)))
    every = let(F.col("_t.h"), lambda h: F.flatten(F.array(*(of_length(h, n) for n in sorted(sets)))))
    return (hit.withColumn("id", F.monotonically_increasing_id()).select("id", "row", F.explode(every).alias("w"))
            .select("id", "row", "w.*"))


def license_scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                 templates: dict[str, str] | None = None) -> DataFrame:
    """For every row and template found in it: the columns `keep`, `template`, `n_found` (its shingles in the
    fullest window), `n_shingles` and `first_word` (where the first window with it begins)."""
    keep = ["doc_id"] if keep is None else keep
    # Bounded by the parameter.
    given = template_table(docs, TEMPLATES if templates is None else templates).collect()
    sets: dict[int, list[int]] = {}
    n_bands: dict[int, int] = {}
    for t in given:
        sets.setdefault(t["words"], []).extend(t["shingles"])
        n_bands[t["words"]] = max(n_bands.get(t["words"], 1), bands(t["words"], len(t["shingles"])))
    spark = docs.sparkSession
    known = F.broadcast(spark.createDataFrame(
        [(t["template"], t["words"], n_bands[t["words"]], t["shingles"]) for t in given],
        "template string, words int, n_bands int, shingles array<long>"))
    posted = F.broadcast(known.select("template", "words", "shingles",
                                      F.posexplode(signature(F.col("shingles"), F.col("n_bands"))).alias("band", "least")))
    if not given:
        return docs.where("false").select(*keep, F.lit("").alias("template"), *(
            F.lit(0).cast("bigint").alias(c) for c in ("n_found", "n_shingles", "first_word")))
    # Stored once, which also fixes the ids that tell repeated rows apart.
    stored = materialize(windows(docs, text, keep, sets), "windows")
    count = F.element_at(F.create_map(*(F.lit(x) for kv in n_bands.items() for x in kv)), F.col("words"))
    signed = stored.select("id", "row", "words", "start", "held",
                           F.posexplode(signature(F.col("held"), count)).alias("band", "least"))
    found = (signed.join(posted, ["words", "band", "least"])
             .withColumn("n", F.size(F.array_intersect("held", "shingles")).cast("bigint"))
             .where(100 * F.col("n") >= PERCENT * F.size("shingles")))
    return (found.groupBy("id", "template").agg(
                F.first("row").alias("row"), F.max("n").alias("n_found"),
                F.first(F.size("shingles")).cast("bigint").alias("n_shingles"),
                F.min("start").cast("bigint").alias("first_word"))
            .select(*(F.col("row")[c].alias(c) for c in keep), "template", "n_found", "n_shingles", "first_word"))
