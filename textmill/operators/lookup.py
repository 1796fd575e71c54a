"""Texts against large tables of strings: an index on one part of each string, one join, and a test on the text.

A text that holds a string also holds all its parts, so the index needs only one part of each
string, the one that the fewest strings share. The parts of each text are looked up in the index, inside the
row or by a join; what comes back are candidates, which the caller tests on the text itself. So a
look-up may find too much, never too little, and its cost follows the text, not rows times strings.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.text import WORD_CHARS, _col
from textmill.runtime import small_table

# An index of at most this many rows and bytes is broadcast; a larger one is joined by shuffle.
INDEX_ROWS = 200_000
INDEX_BYTES = 64_000_000
# An index of at most as many rows and this many bytes is looked up inside the rows.
SLOT_BYTES = 8_000_000
# Characters of the parts that a substring search goes by.
GRAM = 4


def word_runs(text: Column | str, gaps: bool = False) -> Column:
    """Maximal runs of word characters; with `gaps`, the runs between them too."""
    run = f"[{WORD_CHARS}]+" + (f"|[^{WORD_CHARS}]+" if gaps else "")
    return F.regexp_extract_all(_col(text), F.lit(f"({run})"), F.lit(1))


def grams(text: Column | str, size: int) -> Column:
    """Every `size` consecutive characters of a text; none if it is shorter."""
    def at(chars: Column) -> Column:
        starts = F.when(F.size(chars) >= size, F.sequence(F.lit(0), F.size(chars) - size)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(*[F.get(chars, i + k) for k in range(size)]))
    chars = F.filter(F.split(_col(text), ""), lambda c: c != "")
    return F.get(F.transform(F.array(chars), at), F.lit(0))


def rarest_part(table: DataFrame, parts: Column, row: list[str]) -> DataFrame:
    """The table with `_part`, of each row's parts the one that the fewest rows have; ties go to the
    longest, then the smallest. Rows (named by the columns `row`) without parts are left out."""
    each = table.withColumn("_part", F.explode(F.array_distinct(parts)))
    shared = each.groupBy("_part").agg(F.count("*").alias("_shared"))
    order = [F.asc("_shared"), F.desc(F.length("_part")), F.asc("_part")]
    return (each.join(shared, "_part").withColumn("_rn", F.row_number().over(W.partitionBy(*row).orderBy(*order)))
            .where("_rn = 1").drop("_rn", "_shared"))


def _slots(index: DataFrame, fields: list[str]) -> tuple[Column, Column, Column, int] | None:
    """The index as constants: row numbers placed by a hash of the part, the parts, the rows without `_part`, and how
    many places there are. None if it has more than `INDEX_ROWS` rows or `SLOT_BYTES`."""
    hashed = index.select("_part", *fields, F.xxhash64("_part").alias("_hash")).distinct()
    local = hashed.limit(INDEX_ROWS + 1).toArrow()
    if local.num_rows > INDEX_ROWS or local.nbytes > SLOT_BYTES:
        return None
    size = 1 << 16
    while size < 8 * local.num_rows:
        size *= 2
    slots: list[list[int] | None] = [None] * size
    for number, value in enumerate(local.column("_hash").to_pylist()):
        slots[value % size] = [*(slots[value % size] or []), number]
    kinds = ",".join(f"`{c}`:{index.schema[c].dataType.simpleString()}" for c in fields)
    return (F.from_json(F.lit(json.dumps(slots)), "array<array<int>>"),
            F.from_json(F.lit(json.dumps(local.column("_part").to_pylist())), "array<string>"),
            F.from_json(F.lit(json.dumps(local.select(fields).to_pylist())), f"array<struct<{kinds}>>"), size)


def with_candidates(df: DataFrame, text: Column | str, parts: Column, index: DataFrame, how: str = "left") -> DataFrame:
    """Add `_found`: the rows of the index (without `_part`) that share a part with the row's text.

    An index of bounded size enters the projection as constants and is looked up inside each row, so that nothing is
    shuffled. A larger one is joined; texts are then told apart by a hash only, which may add candidates, and rows are
    paired by that hash, not by a key, so null and repeated keys are safe. For the join `df` is read
    twice: pass a stored table, not a long plan.
    """
    fields = [c for c in index.columns if c != "_part"]
    if (constants := _slots(index, fields)) is not None:
        slots, names, rows, size = constants

        def numbers(part: Column) -> Column:
            at = F.get(slots, F.pmod(F.xxhash64(part), F.lit(size)).cast("int"))
            return F.filter(at, lambda e: F.get(names, e) == part)
        lists = F.filter(F.transform(parts, numbers), lambda e: e.isNotNull())
        found = F.transform(F.array_distinct(F.flatten(lists)), lambda e: F.get(rows, e))
        # Exploding an array of one list, or none, does the work once, whatever filter follows.
        one = F.array(found) if how == "left" else F.filter(F.array(found), lambda f: F.size(f) > 0)
        return df.select("*", F.explode(one).alias("_found"))
    same = F.xxhash64(_col(text))
    each = df.select(same.alias("_text"), F.explode(F.array_distinct(parts)).alias("_part"))
    found = (each.join(small_table(index, INDEX_ROWS, INDEX_BYTES), "_part")
             .groupBy("_text").agg(F.collect_set(F.struct(*fields)).alias("_found")))
    return df.withColumn("_text", same).join(found, "_text", how).drop("_text")
