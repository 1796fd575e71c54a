"""Token counts of texts without token ids.

A byte-level tokenizer cuts a text into pre-tokens and never merges across them. So the
pieces of a text are the pieces of its pre-tokens:

1. All distinct pre-tokens of the corpus are gathered with their frequency (combined per task
   before the shuffle), and the pieces of each are counted once by the tokenizer.
2. The pre-token frequencies of each text meet these counts: the most frequent
   pre-tokens, at most `HOT_TOKENS`, are summed inside the task; the rare ones are
   joined by shuffle, with one row per text and distinct rare pre-token.

Strings of special tokens inside a text count as the library counts them: one token
each. Null and empty texts have no tokens. Repeated rows are counted one by one; an
empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import held_by_worker, in_batches, most_frequent
from textmill.runtime import materialize

# Fixed: the public split pattern of byte-level tokenizers.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Code points whose class does not depend on the Unicode version; texts with others are cut by the library.
STABLE = r"[\x00-ԀḀ-⁩₠-₿　-鿿가-힣🌀-🗿]*"
HOT_TOKENS = 100_000
# Pre-tokens a task collects before it passes them on.
FLUSH = 100_000


class PreTokens:
    """Cuts texts as the tokenizer does, special strings apart."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.find = regex.compile(SPLIT).findall
        self.stable = regex.compile(STABLE).fullmatch

    def of(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens in order, and the number of special strings between them."""
        parts = self.special.split(text) if self.special else [text]
        out: list[str] = []
        for p in parts:
            if self.stable(p):
                out += self.find(p)
            else:
                out += [p[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(p)]
        return out, len(parts) - 1

    def pieces(self, tokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]


def pre_tokens(tokenizer: str) -> PreTokens:
    """One per Python worker. The tokenizer's own threads, whose memory would add up, stay off: Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held_by_worker(("pre-tokens", tokenizer), lambda: PreTokens(tokenizer))


def piece_table(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """`token, n, pieces` of every distinct pre-token of the corpus."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cut, found = pre_tokens(tokenizer), Counter()
        for batch in batches:
            for t in batch.column(0):
                found.update(cut.of(t.as_py() or "")[0])
                if len(found) >= FLUSH:
                    yield {"token": list(found), "n": list(found.values())}
                    found = Counter()
        yield {"token": list(found), "n": list(found.values())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cut = pre_tokens(tokenizer)
        for batch in batches:
            yield {"token": batch.column("token"), "n": batch.column("n"),
                   "pieces": cut.pieces(batch.column("token").to_pylist())}

    distinct = in_batches(docs.select(text), gather, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return in_batches(distinct, count, "token string, n long, pieces long")


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None,
                 hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """For every row: the columns `keep`, n_bytes and n_tokens."""
    spark = docs.sparkSession
    keep = ["doc_id"] if keep is None else keep
    pieces = materialize(piece_table(docs, tokenizer, text), "pieces")
    sent = spark.sparkContext.broadcast(most_frequent(pieces, "n", hot_tokens).select("token", "pieces").toArrow())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cut = pre_tokens(tokenizer)
        hot = dict(zip(sent.value.column("token").to_pylist(), sent.value.column("pieces").to_pylist()))
        for batch in batches:
            n_bytes, hot_sum, rare = [], [], []
            for t in batch.column("_text"):
                t = t.as_py() or ""
                tokens, total = cut.of(t)
                cold = []
                for token, n in Counter(tokens).items():
                    p = hot.get(token)
                    if p is None:
                        cold.append({"token": token, "n": n})
                    else:
                        total += n * p
                n_bytes.append(len(t.encode()))
                hot_sum.append(total)
                rare.append(cold)
            yield {**{c: batch.column(c) for c in keep}, "n_bytes": n_bytes, "_hot": hot_sum, "_rare": rare}

    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("_hot", T.LongType()),
        T.StructField("_rare", T.ArrayType(T.StructType([T.StructField("token", T.StringType()),
                                                         T.StructField("n", T.LongType())])))])
    # The row number is fixed by being stored.
    rows = materialize(in_batches(docs.select(*keep, F.col(text).alias("_text")), work, schema)
                       .withColumn("_row", F.monotonically_increasing_id()), "frequencies")
    cold = (rows.select("_row", F.explode("_rare").alias("r")).select("_row", "r.token", F.col("r.n").alias("k"))
            .join(pieces.select("token", "pieces"), "token")
            .groupBy("_row").agg(F.sum(F.col("k") * F.col("pieces")).alias("_cold")))
    return (rows.join(cold, "_row", "left")
            .select(*keep, "n_bytes", (F.col("_hot") + F.coalesce(F.col("_cold"), F.lit(0))).alias("n_tokens")))
