"""One large JSON array per file, read by many tasks.

Spark splits a text file wherever a separator allows it. With the comma as separator a split begins at
some comma, which may lie inside a string or a nested array, so a task alone cannot tell where
an element begins. Two passes settle it:

1. Each task goes over its pieces once for either assumption, that its split begins inside
   a string or outside, and says what state the split ends in, how the nesting depth has changed, and how many
   pieces begin at which depth. The driver chains these few numbers per split, in file order.
2. With the true state and position at its start, each task puts the pieces of an element together again and
   numbers it. Only the first and last element of a split may have parts in others; these are joined by shuffle.

A backslash cannot stand right before a separating comma in valid JSON, so no escape crosses a border.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPE = re.compile(r"\\.", re.S)


def _depth(text: str) -> int:
    return text.count("[") + text.count("{") - text.count("]") - text.count("}")


def scan_piece(piece: str) -> tuple[int, int, int]:
    """Whether a piece toggles between inside and outside of a string (0 or 1), and the change
    of depth if it begins outside, and inside."""
    if "\\" in piece:
        piece = _ESCAPE.sub("", piece)
    parts = piece.split('"')
    return (len(parts) - 1) & 1, sum(map(_depth, parts[::2])), sum(map(_depth, parts[1::2]))


class Split:
    """What a split does to the state, for a start outside (0) and inside (1) of a string."""

    def __init__(self) -> None:
        self.inside, self.depth = [0, 1], [0, 0]
        # Pieces that begin outside of strings, by their depth relative to the split's start.
        self.begins = [Counter(), Counter()]
        self.head = ""

    def add(self, piece: str) -> None:
        if not self.head:
            self.head = piece.strip()[:1]
        change = scan_piece(piece)
        for v in (0, 1):
            if not self.inside[v]:
                self.begins[v][self.depth[v]] += 1
            self.depth[v] += change[1 + self.inside[v]]
            self.inside[v] ^= change[0]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        for file, block, value in zip(*(batch.column(c) for c in ("file", "block", "value"))):
            yield (file.as_py(), block.as_py()), value.as_py()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splits: dict[tuple[str, int], Split] = defaultdict(Split)
    for at, piece in _pieces(batches):
        splits[at].add(piece)
    rows = [{"file": f, "block": b, "head": s.head, "inside": s.inside, "depth": s.depth,
             "begins": [[{"depth": d, "n": n} for d, n in c.items()] for c in s.begins]} for (f, b), s in splits.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("head", pa.string()), ("inside", pa.list_(pa.int32())),
        ("depth", pa.list_(pa.int64())),
        ("begins", pa.list_(pa.list_(pa.struct([("depth", pa.int64()), ("n", pa.int64())]))))]))


def starts(splits: list[dict]) -> dict[tuple[str, int], tuple[int, int, int]]:
    """(inside, depth, elements begun before) at the start of each split."""
    out = {}
    state, file, head = (0, 0, 0), None, ""

    def close() -> None:
        if file is not None and (state[:2] != (0, 0) or head != "["):
            raise ValueError(f"not a JSON array: {file}")

    for s in sorted(splits, key=lambda s: (s["file"], s["block"])):
        if s["file"] != file:
            close()
            state, file, head = (0, 0, 0), s["file"], ""
        head = head or s["head"]
        inside, depth, n = out[file, s["block"]] = state
        # Elements begin at depth 1; the file's first piece, at depth 0, begins one as well.
        begun = sum(b["n"] for b in s["begins"][inside] if depth + b["depth"] == 1) + (s["block"] == 0)
        state = s["inside"][inside], depth + s["depth"][inside], n + begun
    close()
    return out


def _elements(state_of: dict[tuple[str, int], tuple[int, int, int]]):
    schema = pa.schema([("file", pa.string()), ("idx", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()),
                        ("last", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        at, parts, inside, depth, n, own = None, [], 0, 0, 0, False

        def flush(ends_here: bool) -> None:
            if parts:
                rows.append({"file": at[0], "idx": n - 1, "block": at[1], "whole": own and ends_here, "last": depth == 0,
                             "text": ",".join(parts)})

        for here, piece in _pieces(batches):
            if here != at:
                flush(False)
                at, parts, own = here, [], False
                inside, depth, n = state_of[at]
            if not inside and (depth == 1 or n == 0 and at[1] == 0):
                flush(True)
                parts, own, n = [], True, n + 1
            parts.append(piece)
            change = scan_piece(piece)
            depth += change[1 + inside]
            inside ^= change[0]
            if len(rows) >= 2_000:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        flush(False)
        yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def array_elements(spark: SparkSession, path: str, element: str) -> DataFrame:
    """(file, idx, value): the elements of JSON arrays, one array per file, of the type `element` (DDL).

    The first pass runs when this is called. A file that is no array fails, and so does a
    value that does not parse.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    state = ("file string, block long, head string, inside array<int>, depth array<long>, "
             "begins array<array<struct<depth:long,n:long>>>")
    state_of = starts(pieces.mapInArrow(_scan, state).toArrow().to_pylist())
    rows = pieces.mapInArrow(_elements(state_of),
                             "file string, idx long, block long, whole boolean, last boolean, text string")
    order = F.array_sort(F.collect_list(F.struct("block", "text")))
    parts = rows.where("not whole").groupBy("file", "idx").agg(
        F.bool_or("last").alias("last"), F.array_join(F.transform(order, lambda p: p["text"]), ",").alias("text"))
    every = rows.where("whole").select("file", "idx", "last", "text").unionByName(parts)
    bare = F.when(F.col("idx") == 0, F.regexp_replace("text", r"^\s*\[", "")).otherwise(F.col("text"))
    bare = F.when(F.col("last"), F.regexp_replace(bare, r"\]\s*$", "")).otherwise(bare)
    blank = F.trim(F.translate("bare", "\t\r\n", "   ")) == ""
    # A blank element is the inside of an empty array; anywhere else it is an error.
    text = F.when(blank, F.raise_error(F.lit("an element is missing"))).otherwise(F.concat(F.lit("["), "bare", F.lit("]")))
    value = F.get(F.from_json(text, f"array<{element}>", {"mode": "FAILFAST"}), F.lit(0))
    return (every.withColumn("bare", bare).where(~((F.col("idx") == 0) & F.col("last") & blank))
            .select("file", F.col("idx").cast("int").alias("idx"), value.alias("value")))
