"""Ranked lexical search with hashed max-sketches.

1. One pass counts the documents with terms, all their terms, and the documents that hold each
   term of a block of queries.
2. In a second pass, every document's terms fold into a sketch of `SKETCH` coordinates: a term
   goes to the coordinate of its hash, which keeps the largest impact that comes to it.
   Impacts grow with the term's frequency, so the largest frequency is folded and turned into an impact once.
3. The queries of the block are looked up in all sketches of a batch at once: the sum of a
   query's weights times the sketch is never below the document's score. Coordinates that
   no query of the block looks up are not kept.
4. Per query, the documents of a batch are scored exactly in descending order of that bound, until
   it falls below the `k`-th best score that the task has found so far. The best `k`
   of each task are merged by Spark, in two salted rounds.

Queries are read in blocks of bounded size, so their tables may be sent to all tasks; each block passes
over the documents. Scores are integers, so results do not depend on the order of sums.

A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))); a document's norm m is
100 - 50 + (50 n N) div L for its n terms, N documents with terms and L terms of all; its
score sums weight * ((10^9 tf) div (1000 tf + 20 m)) over the distinct terms of the query.

Null and empty texts have no terms: such documents are never found, such queries find
nothing. Equal scores are ordered by document id, null first. Repeated rows are ranked
each; repeated query ids are queries of their own. An empty table on either side gives an empty result. Only
the named columns are read, so other columns never clash.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import in_batches
from textmill.operators.ranking import top_per_group
from textmill.runtime import materialize

SKETCH = 1 << 14
TOP = 50
# A block of queries ends at either number.
BLOCK_QUERIES = 1_000
BLOCK_TERMS = 20_000
# Terms whose coordinate a worker remembers; the table is started anew when full.
KNOWN_TERMS = 200_000
# Digits, letters and all bytes above ASCII make terms; the rest separates them.
_FOLD = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """The terms of UTF-8 text in order, A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


def impact(tf, m):
    """Of whole numbers or arrays of them."""
    return 1_000_000_000 * tf // (1_000 * tf + 20 * m)


class Block:
    """Queries with their distinct terms, and the corpus statistics that weigh them."""

    def __init__(self, queries: list[list[bytes]]):
        self.queries = [list(dict.fromkeys(q)) for q in queries]
        self.wanted = frozenset(t for q in self.queries for t in q)

    def weigh(self, df: dict[bytes, int], n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in self.wanted if t in df}
        self.queries = [[(t, weight[t]) for t in q if t in weight] for q in self.queries]
        self.wanted = frozenset()

    def lookups(self, size: int) -> tuple[dict[int, int], list[tuple[np.ndarray, np.ndarray]]]:
        """The coordinates that are looked up, numbered, and for each query their numbers and weights."""
        number, out = {}, []
        for q in self.queries:
            at = [number.setdefault(zlib.crc32(t) % size, len(number)) for t, _ in q]
            out.append((np.array(at, np.int64), np.array([w for _, w in q], float).reshape(-1, 1)))
        return number, out

    def norm(self, n: int) -> int:
        return 100 - 50 + 50 * n * self.n_docs // self.n_terms


def statistics(docs: DataFrame, block: Block) -> tuple[dict[bytes, int], int, int]:
    """Document frequencies of the block's terms, documents with terms, and all their terms."""
    wanted = docs.sparkSession.sparkContext.broadcast(block.wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        df, n_docs, n_terms = Counter(), 0, 0
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()):
                found = terms(t.as_py())
                if found:
                    n_docs += 1
                    n_terms += len(found)
                    df.update(wanted.value.intersection(found))
        yield {"term": [None, *df], "n": [n_docs, *df.values()], "n_terms": [n_terms, *([0] * len(df))]}

    rows = (in_batches(docs.select("_text"), work, "term binary, n long, n_terms long")
            .groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_terms").alias("n_terms")).toArrow().to_pylist())
    total = next((r for r in rows if r["term"] is None), {"n": 0, "n_terms": 0})
    return {r["term"]: r["n"] for r in rows if r["term"] is not None}, total["n"], total["n_terms"]


class Sketches:
    """Max-sketches of batches of documents; only coordinates in `number` are kept."""

    def __init__(self, size: int, number: dict[int, int]):
        self.size, self.number, self.place = size, number, {}

    def fold(self, counts: list[Counter], norms: np.ndarray) -> np.ndarray:
        """One row per coordinate, one column per document."""
        most = np.zeros((len(self.number) + 1, len(counts)), np.int64)
        for d, c in enumerate(counts):
            missing = [t for t in c if t not in self.place]
            if missing:
                if len(self.place) + len(missing) > KNOWN_TERMS:
                    self.place.clear()
                    missing = list(c)
                # The last row takes what no query looks up.
                self.place.update((t, self.number.get(zlib.crc32(t) % self.size, -1)) for t in missing)
            at = np.fromiter(map(self.place.__getitem__, c), np.int64, len(c))
            kept = np.flatnonzero(at >= 0)
            np.maximum.at(most[:, d], at[kept], np.fromiter(c.values(), np.int64, len(c))[kept])
        return impact(most[:-1], norms).astype(np.int32)


def best_of_task(batches: Iterator[pa.RecordBatch], block: Block, k: int, size: int) -> Iterator[dict]:
    """The `k` best documents (or all, if fewer) of each query among a task's documents."""
    number, lookups = block.lookups(size)
    sketches = Sketches(size, number)
    # Heaps of (score, id is null, -id, id): the smallest entry is the one to be replaced.
    found: list[list[tuple]] = [[] for _ in block.queries]
    for batch in batches:
        ids, counts = [], []
        for i, t in zip(batch.column("_id").to_pylist(), batch.column("_text").cast(pa.binary())):
            if c := Counter(terms(t.as_py())):
                ids.append(i)
                counts.append(c)
        if not ids:
            continue
        norms = [block.norm(c.total()) for c in counts]
        folded = sketches.fold(counts, np.array(norms, np.int64))
        for q, (at, weights) in enumerate(lookups):
            heap = found[q]
            least = heap[0][0] if len(heap) == k else 1
            # Products of whole numbers; the margin covers rounding in very long queries.
            upper = (folded[at] * weights).sum(axis=0) * (1 + 1e-9)
            hopeful = np.flatnonzero(upper >= least)
            for d in hopeful[np.argsort(-upper[hopeful], kind="stable")].tolist():
                if upper[d] < least:
                    break
                c, m = counts[d], norms[d]
                score = sum([w * impact(c[t], m) for t, w in block.queries[q] if t in c])
                if score > 0:
                    entry = (score, ids[d] is None, -(ids[d] or 0), ids[d])
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry[:3] > heap[0][:3]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        least = heap[0][0]
    for q, heap in enumerate(found):
        if heap:
            yield {"_query": [q] * len(heap), "doc_id": [e[3] for e in heap], "score": [e[0] for e in heap]}


def _blocks(queries: DataFrame, max_queries: int, max_terms: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    ids, texts, held = [], [], 0
    for query_id, text in queries.toLocalIterator():
        ids.append(query_id)
        texts.append(terms(text.encode() if text else None))
        held += len(texts[-1])
        if len(ids) >= max_queries or held >= max_terms:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def search(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", text: str = "text", query_id: str = "item_id",
           query_text: str = "text", k: int = TOP, sketch: int = SKETCH, block_queries: int = BLOCK_QUERIES,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """`query_id`, rank, doc_id, score: the `k` documents with the highest scores above 0 of each query."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    names = T.StructType([T.StructField("_query", T.LongType()), queries.schema[query_id]])
    parts = []
    for ids, texts in _blocks(queries.select(query_id, query_text), block_queries, block_terms):
        block = Block(texts)
        df, n_docs, n_terms = statistics(rows, block)
        block.weigh(df, n_docs, n_terms)
        sent = spark.sparkContext.broadcast(block)
        best = in_batches(rows, lambda batches, sent=sent: best_of_task(batches, sent.value, k, sketch),
                          "_query long, doc_id long, score long")
        order = [F.desc("score"), F.asc_nulls_first("doc_id")]
        rank = F.row_number().over(Window.partitionBy("_query").orderBy(*order))
        # Named by a local table of at most a block's queries.
        local = F.broadcast(spark.createDataFrame(list(enumerate(ids)), names))
        parts.append(materialize(top_per_group(best, ["_query"], order, k).withColumn("rank", rank).join(local, "_query")
                                 .select(query_id, "rank", "doc_id", "score"), "found"))
    if not parts:
        return spark.createDataFrame([], T.StructType([queries.schema[query_id], T.StructField("rank", T.IntegerType()),
                                                       T.StructField("doc_id", T.LongType()),
                                                       T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionAll, parts)
