"""Best-fit packing of token sequences by minimum bin slack.

1. Every text becomes token ids (by the public tokenizer, with an end id); only
   sequences above the limit are cut, into full pieces and a last shorter one. The
   ids stay inside the task: a piece is stored as its place, length and checksum.
2. The corpus is summed up as a histogram of piece lengths: at most `limit` counts,
   whatever the number of pieces.
3. From that histogram the driver makes *patterns*: the longest available length is
   set, a bitset subset-sum over the other available lengths finds the fullest bin
   that holds it, and the pattern is used as often as the counts allow. Each pattern
   uses up a length, so there are few, however many bins they stand for.
4. Pieces are numbered within their length in hash buckets, and the number says
   which bin of which pattern they go to, and where.

Null texts are empty: their one piece is the end id. Repeated rows are packed one
by one. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import held_by_worker, in_batches, numbered
from textmill.runtime import materialize

LIMIT = 2048
END_ID = 0
# Entries of a worker's table of encoded words, some 200 bytes each; it is started anew when full.
CACHE_WORDS = 1_500_000
# Words of plain letters (here as UTF-8) with plain signs behind them. Case and signs are taken off such a word
# before it is encoded, since the tokenizer lower-cases and never merges letters with signs.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?*#$%|]*)")


class WordIds:
    """Ids of white-space separated words as little-endian bytes.

    For tokenizers that lower-case, drop white space and mark the end of words, so that words can be
    encoded one by one.
    """

    def __init__(self, tokenizer: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.cache_words = cache_words
        self.table: dict[bytes, bytes] = {}
        # Whether an id ends a word.
        end = json.loads(self.tokenizer.to_str())["model"]["end_of_word_suffix"]
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(end)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in coded]

    def learn(self, words: set[bytes]) -> None:
        """Add words that the table lacks."""
        table, plain = self.table, _PLAIN.fullmatch
        known, bases, tails, rest, letters, signs = [], [], [], [], set(), set()
        for w in words:
            if m := plain(w):
                base, tail = m.groups()
                base = base.decode().lower().encode() if b"\xc3" in base else base.lower()
                if base not in table:
                    letters.add(base)
                if tail or base != w:
                    known.append(w)
                    bases.append(base)
                    tails.append(tail)
                    if tail and tail not in table:
                        signs.add(tail)
            else:
                rest.append(w)
        for group in (sorted(letters), sorted(signs)):
            # One text with blanks between: each word is one pre-token, which ends with an end-of-word id.
            if group:
                e, = self.tokenizer.encode_batch_fast([b" ".join(group).decode()], add_special_tokens=False)
                ids = np.array(e.ids, "<u4")
                cuts = [0, *((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()]
                ids = ids.tobytes()
                table.update(zip(group, map(ids.__getitem__, map(slice, cuts, cuts[1:]))))
        for w, base, tail in zip(known, bases, tails):
            table[w] = table[base] + table[tail] if tail else table[base]
        if rest:
            table.update(zip(rest, self._encode([w.decode() for w in rest])))

    def of(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of an array without nulls."""
        split = [t.split() for t in texts.cast(pa.binary()).to_pylist()]
        distinct = set().union(*split)
        if missing := distinct.difference(self.table):
            if len(self.table) + len(missing) > self.cache_words:
                self.table.clear()
                missing = distinct
            self.learn(missing)
        # A table of these texts' words alone is small enough to be read fast.
        own = dict(zip(distinct, map(self.table.__getitem__, distinct)))
        return [b"".join(map(own.__getitem__, words)) for words in split]


def word_ids(tokenizer: str, cache_words: int) -> WordIds:
    """One table per Python worker, which serves many tasks. The tokenizer's own threads stay off: Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held_by_worker(("word ids", tokenizer, cache_words), lambda: WordIds(tokenizer, cache_words))


def cut_pieces(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None,
               limit: int = LIMIT, end_id: int = END_ID, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces of every row: the columns `keep`, piece, start, length, ids_crc32."""
    keep = ["doc_id"] if keep is None else keep
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = word_ids(tokenizer, cache_words)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for r, ids in enumerate(coder.of(batch.column("_text"))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    rows.append(r)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            at = pa.array(rows, pa.int64())
            yield {**{c: batch.column(c).take(at) for c in keep}, "piece": piece, "start": start, "length": length,
                   "ids_crc32": crc}

    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return in_batches(docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text")), work, schema)


def fullest(seed: int, counts: dict[int, int], limit: int) -> list[int]:
    """Lengths that fill a bin with `seed` as far as any choice of the available lengths can.

    Bit s of `reach` says that some choice sums to s. Copies of a length are
    added in doubling steps, so a length costs a few shifts of one long integer.
    """
    room = limit - seed
    if room <= 0:
        return [seed]
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for size in sorted(counts, reverse=True):
        left = min(counts[size] - (size == seed), room // size)
        copies = 1
        while left > 0:
            k = min(copies, left)
            steps.append((size, k, reach))
            reach |= (reach << (k * size)) & mask
            left -= k
            copies *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    found = [seed]
    for size, k, before in reversed(steps):
        if not before >> at & 1:
            found += [size] * k
            at -= size * k
    return found


def make_patterns(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, list[tuple[int, int]]]]:
    """(number of bins, [(length, copies in each bin)]), longest lengths first."""
    counts, out = {k: v for k, v in histogram.items() if v > 0}, []
    while counts:
        seed = max(counts)
        bins = fullest(seed, counts, limit)
        copies = {s: bins.count(s) for s in sorted(set(bins), reverse=True)}
        times = min(counts[s] // n for s, n in copies.items())
        out.append((times, list(copies.items())))
        for s, n in copies.items():
            counts[s] -= n * times
            if not counts[s]:
                del counts[s]
    return out


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds sequence_id and offset to stored pieces with a column `length` (1 to `limit`)."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places: dict[int, list[tuple[int, int, int, int]]] = {}  # by length: first number, copies, first bin, offset
    used, first = dict.fromkeys(histogram, 0), 0
    for times, copies in make_patterns(histogram, limit):
        offset = 0
        for size, n in copies:
            places.setdefault(size, []).append((used[size], n, first, offset))
            used[size] += n * times
            offset += n * size
        first += times
    tables = {size: np.array(p, np.int64).T for size, p in places.items()}
    sent = spark.sparkContext.broadcast(tables)
    names = pieces.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy()
            seq, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for s in np.unique(size):
                rows = size == s
                begin, copies, bins, at = sent.value[int(s)]
                p = np.searchsorted(begin, number[rows], "right") - 1
                k = number[rows] - begin[p]
                seq[rows] = bins[p] + k // copies[p]
                offset[rows] = at[p] + k % copies[p] * s
            yield {**{c: batch.column(c) for c in names}, "sequence_id": seq, "offset": offset}

    schema = T.StructType(list(pieces.schema) + [T.StructField("sequence_id", T.LongType()),
                                                 T.StructField("offset", T.LongType())])
    order = [c for c in names if c != "length"]
    return in_batches(numbered(pieces, "length", order, order, "_number"), work, schema)


def best_fit_packing(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None,
                     limit: int = LIMIT, end_id: int = END_ID, cache_words: int = CACHE_WORDS) -> DataFrame:
    """The pieces of all rows with their sequence and the place there."""
    return pack(materialize(cut_pieces(docs, tokenizer, text, keep, limit, end_id, cache_words), "pieces"), limit)
