"""Spelling variants: words one letter apart, grouped below their most frequent form.

1. Words are counted by Spark; only those of enough letters and occurrences stay.
2. Two words one edit apart agree outside the place of the edit. The shorter one's length is
   cut into `PIECES` pieces, and a word goes to one bucket per piece, keyed by all of it
   but that piece, once as the shorter and once as the longer word of a pair. So each pair
   meets in a bucket, and words of a bucket share most of their letters.
3. A bucket is indexed by bitsets: one per position and letter, with a bit for every word that
   has the letter there. For each word of the bucket, the sets of words that
   match its first letters without error, with one letter replaced, and with one letter
   more are carried on letter by letter, all words of the bucket at once.
4. A word's form is its near word of largest count, if that is large enough. Counts at
   least double along forms (with the default factor), so chains are short; roots are found by pointer jumping.

A bucket of more than `MAX_BUCKET` words is dealt anew, by the word without one letter
of that piece. Words of such a bucket differ in one letter at one place, or are one word and its
extensions by a letter, so its size is bounded by the alphabet and the length.

Null texts have no words; an empty table gives an empty result. Repeated rows count each.
Ties between forms go to the smaller word in code-point order. A null id is written as nothing
where ids enter a hash. Only the named columns are read, so other columns never clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import checked_small, in_batches, let
from textmill.runtime import materialize

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECES = 4
MAX_BUCKET = 4096


def with_slips(run: Column, doc_id: Column, every: int) -> Column:
    """The run without one of its letters, wherever `every` divides the checksum of "id:run"."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))

    def cut(h: Column) -> Column:
        at = F.pmod(h, F.char_length(run).cast("bigint")).cast("int")
        return F.when(h % every == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.char_length(run)))
                      ).otherwise(run)
    return let(mark, cut)


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 5, min_count: int = 3,
                slip_every: int | None = None) -> DataFrame:
    """`word, n` of all runs of letters, A-Z lower-cased, that are long and frequent enough.

    With `slip_every`, letters are left out as `with_slips` says, which plants misspellings to find.
    """
    runs = docs.select(F.col(doc_id).alias("id"), F.explode(F.regexp_extract_all(
        F.translate(text, UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    word = F.col("run") if slip_every is None else with_slips(F.col("run"), F.col("id"), slip_every)
    return (runs.select(word.alias("word")).where(F.char_length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def bounds(size: int) -> list[int]:
    """Where the pieces of `size` letters begin, and the end."""
    return [size * i // PIECES for i in range(PIECES + 1)]


def bucket_rows(words: DataFrame) -> DataFrame:
    """`word, n, size, piece, bucket`: size is the shorter word's, bucket a hash of the word but for the piece."""
    length = F.char_length("word")
    ends = F.array(*(F.struct(F.lit(longer).alias("longer"), F.lit(i).alias("piece"),
                              F.floor((length - longer) * i / PIECES).cast("int").alias("a"),
                              (F.floor((length - longer) * (i + 1) / PIECES) + longer).cast("int").alias("b"))
                     for longer in (0, 1) for i in range(PIECES)))
    put = words.withColumn("p", F.explode(ends)).select(
        "word", "n", (length - F.col("p.longer")).alias("size"), "p.piece", "p.a", "p.b")
    w = F.col("word")
    return put.withColumn("bucket", F.xxhash64("size", "piece", w.substr(F.lit(1), F.col("a")),
                                               w.substr(F.col("b") + 1, length)))


def deal_anew(rows: DataFrame) -> DataFrame:
    """Rows of large buckets, dealt by the word without one letter of the piece."""
    w, n = F.col("word"), F.char_length("word")
    longer = n > F.col("size")
    # A word is keyed by each letter left out; as the shorter of a pair also by itself (place -1).
    places = F.when(F.col("b") > F.col("a"), F.sequence(F.col("a"), F.col("b") - 1)).otherwise(F.array().cast("array<int>"))
    keys = F.transform(places, lambda p: F.xxhash64(
        "bucket", F.when(longer, F.lit(-1)).otherwise(p), F.concat(w.substr(F.lit(1), p), w.substr(p + 2, n))))
    own = F.when(longer, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64("bucket", F.lit(-1), w)))
    return rows.withColumn("bucket", F.explode(F.array_distinct(F.concat(keys, own))))


def near_words(words: list[str], size: int) -> Iterator[tuple[int, int]]:
    """(i, j): word j has one letter replaced in word i, of `size` letters, or one letter more."""
    at: dict[tuple[int, str], int] = defaultdict(int)
    short = long = 0
    for v, w in enumerate(words):
        bit = 1 << v
        if len(w) == size:
            short |= bit
        else:
            long |= bit
        for p, c in enumerate(w):
            at[p, c] |= bit
    for i, q in enumerate(words):
        if len(q) != size:
            continue
        exact, replaced, inserted = short | long, 0, 0
        for p, c in enumerate(q):
            here = at[p, c]
            replaced = replaced & here | exact & ~here
            inserted = (inserted | exact) & at.get((p + 1, c), 0)
            exact &= here
        found = replaced & short | (inserted | exact) & long
        while found:
            j = found.bit_length() - 1
            found ^= 1 << j
            yield i, j


def meet_here(short: str, other: str, size: int, piece: int) -> bool:
    """Whether `piece` is the first whose bucket holds both words."""
    cut, e = bounds(size), len(other) - size
    return not any(short[:a] == other[:a] and short[b:] == other[b + e:] for a, b in zip(cut[:piece], cut[1:]))


def near_pairs(words: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """`word, near, near_n`: every near pair of a stored table `word, n`, both ways, each once."""
    rows = bucket_rows(words)
    large = checked_small(rows.groupBy("bucket").count().where(F.col("count") > max_bucket).select("bucket"), name="large")
    rows = (rows.join(large, "bucket", "left_anti").unionByName(deal_anew(rows.join(large, "bucket", "left_semi")))
            .select("bucket", "size", "piece", "word", "n"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def of_bucket(key: tuple, members: list[tuple[str, int]], out: dict) -> None:
            _, size, piece = key
            for i, j in near_words([w for w, _ in members], size):
                (q, q_n), (v, v_n) = members[i], members[j]
                if meet_here(q, v, size, piece):
                    # Equal lengths are met from both sides.
                    for a, b, n in ((q, v, v_n), (v, q, q_n))[:1 + (len(v) > size)]:
                        out["word"].append(a)
                        out["near"].append(b)
                        out["near_n"].append(n)

        held, members = None, []
        for batch in batches:
            out = {"word": [], "near": [], "near_n": []}
            for *key, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if key != held:
                    if len(members) > 1:
                        of_bucket(held, members, out)
                    held, members = key, []
                members.append((word, n))
            yield out
        if len(members) > 1:
            out = {"word": [], "near": [], "near_n": []}
            of_bucket(held, members, out)
            yield out

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "size", "piece")
    return in_batches(dealt, work, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """`word, root` for every row `word, form` of a table without cycles, by pointer jumping."""
    now = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while now.where("moved").limit(1).count():
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialize(now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return now.select("word", "root")


def variant_groups(words: DataFrame, factor: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """`word, n, n_near, form, form_n, root` for every row `word, n` (words distinct).

    The form is the most frequent near word, if it occurs at least `factor` times (2 or
    more) as often; the root is the end of the chain of forms.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms could run in circles")
    words = materialize(words.select("word", "n"), "words")
    best = near_pairs(words, max_bucket).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("top"))
    takes = -F.col("top.m") >= factor * F.col("n")
    found = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(takes, F.col("top.near")).alias("form"), F.when(takes, -F.col("top.m")).alias("form_n")), "forms")
    ends = roots(found.where(F.col("form").isNotNull()))
    return (found.join(ends, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
