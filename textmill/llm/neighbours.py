"""Approximate nearest neighbours by a permutation index.

1. Equal vectors are one class with its smallest ids, combined per task before the shuffle, so
   a vector that a third of all rows share is a row per task.
2. A bounded sample of vectors (`PIVOTS`) are the pivots. Every vector is represented by the order
   in which it meets the pivots, nearest first. The index holds blocks of vectors
   with one inverted file per pivot: the place of the pivot in the order of each vector.
3. The queries, a stated set, go against the index in blocks of `QUERY_BLOCK`. In an
   index block the files give every vector's footrule distance to a query (sum of
   differences of places); the nearest `RERANK` share is ranked anew by the exact cosine.
4. Each task passes on its best classes per query; a window takes the best of all.

Ranking by footrule is what makes the search approximate; `recall` is measured in the tests.
Vectors that are null, zero, of another length than most vectors, or hold null or non-finite
numbers take no part, nor do rows without id. Repeated rows count once. Ties go to the
smaller id. An empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import in_batches
from textmill.runtime import materialize

K = 5
PIVOTS = 256  # places fit a byte
RERANK = 0.04
# At least so many vectors of an index block are ranked anew: small tables are searched exactly.
RERANK_LEAST = 200
INDEX_BLOCK = 2048
QUERY_BLOCK = 4096
# Vectors a task holds while it combines equal ones.
FLUSH = 50_000


def _usable(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (double) of the rows that take part."""
    ids, rows = [], []
    for i, v in zip(batch.column("id").to_pylist(), batch.column("vec").to_pylist()):
        if i is not None and v is not None and len(v) == dim and None not in v:
            ids.append(i)
            rows.append(v)
    x = np.array(rows, np.float64).reshape(len(rows), dim) + 0.0  # one sign of zero
    good = np.isfinite(x).all(axis=1) & x.any(axis=1)
    return np.array(ids, np.int64)[good], x[good]


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def places(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For every vector and pivot, the pivot's place in the vector's order (0: nearest)."""
    order = np.argsort(-(unit @ pivots.T), axis=1, kind="stable")
    out = np.empty(order.shape, np.uint8)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.uint8)[None], axis=1)
    return out


def classes(rows: DataFrame, dim: int, per_class: int) -> DataFrame:
    """`vec` (bytes of doubles), `ids`: the classes of equal vectors with their smallest ids."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def passed_on(held: dict) -> dict:
            return {"vec": list(held), "ids": [sorted(s)[:per_class] for s in held.values()]}
        held: dict[bytes, set] = {}
        for batch in batches:
            for i, v in zip(*_usable(batch, dim)):
                ids = held.setdefault(v.tobytes(), set())
                ids.add(int(i))
                if len(ids) > 4 * per_class:
                    held[v.tobytes()] = set(sorted(ids)[:per_class])
            if len(held) >= FLUSH:
                yield passed_on(held)
                held = {}
        yield passed_on(held)

    return (in_batches(rows, local, "vec binary, ids array<long>").groupBy("vec")
            .agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, per_class).alias("ids")))


def build_index(found: DataFrame, dim: int, pivots: np.ndarray) -> DataFrame:
    """One row per block of classes: `vecs`, `ids`, and `files`, the inverted file of each pivot in turn."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        vecs, ids = [], []

        def block() -> dict:
            x = np.frombuffer(b"".join(vecs), np.float64).reshape(-1, dim)
            return {"vecs": [x.tobytes()], "ids": [ids],
                    "files": [np.ascontiguousarray(places(_unit(x), pivots).T).tobytes()]}
        for batch in batches:
            for v, i in zip(batch.column("vec").to_pylist(), batch.column("ids").to_pylist()):
                vecs.append(v)
                ids.append(i)
                if len(vecs) == INDEX_BLOCK:
                    yield block()
                    vecs, ids = [], []
        if vecs:
            yield block()
    return in_batches(found, work, "vecs binary, ids array<array<long>>, files binary")


def _search(index: DataFrame, queries: list[bytes], dim: int, pivots: np.ndarray, best: int) -> DataFrame:
    """`query` (bytes), `ids`, `score`: each task's best classes for every query."""
    sent = index.sparkSession.sparkContext.broadcast(queries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        q = _unit(np.frombuffer(b"".join(sent.value), np.float64).reshape(-1, dim))
        own = places(q, pivots).astype(np.int16)
        top: list[list] = [[] for _ in q]
        for batch in batches:
            for vecs, ids, files in zip(*(batch.column(c).to_pylist() for c in ("vecs", "ids", "files"))):
                x = _unit(np.frombuffer(vecs, np.float64).reshape(-1, dim))
                file = np.frombuffer(files, np.uint8).reshape(len(pivots), -1).astype(np.int16)
                first = np.array([i[0] for i in ids])
                n = min(len(x), max(RERANK_LEAST, int(np.ceil(RERANK * len(x)))))
                for j in range(len(q)):
                    near = np.arange(len(x))
                    if n < len(x):
                        footrule = np.abs(file - own[j][:, None]).sum(axis=0, dtype=np.int32)
                        near = np.argpartition(footrule, n - 1)[:n]
                    scores = x[near] @ q[j]
                    for k in np.lexsort((first[near], -scores))[:best]:
                        top[j].append((-scores[k], int(first[near[k]]), ids[near[k]]))
                    top[j] = sorted(top[j])[:best]
        rows = [(sent.value[j], i, -s) for j, found in enumerate(top) for s, _, i in found]
        yield dict(zip(("query", "ids", "score"), map(list, zip(*rows)))) if rows else {"query": [], "ids": [], "score": []}

    return in_batches(index, work, "query binary, ids array<long>, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id",
            embedding: str = "embedding", n_pivots: int = PIVOTS) -> DataFrame:
    """`query_id, rank, vec_id, score` of the `k` nearest rows of `vectors` for every row of `queries`.

    `queries` are rows of the same table; a row is no neighbour of its own id.
    """
    spark = vectors.sparkSession

    def narrow(df: DataFrame) -> DataFrame:
        return df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("vec"))

    result = "query_id bigint, rank int, vec_id bigint, score double"
    most = (vectors.where(F.size(embedding) > 0).groupBy(F.size(embedding).alias("d")).count()
            .orderBy(F.desc("count"), "d").first())
    if most is None:
        return spark.createDataFrame([], result)
    dim = most["d"]
    found = materialize(classes(narrow(vectors), dim, k + 1), "classes")
    sample = found.orderBy(F.xxhash64("vec"), "vec").limit(n_pivots).select("vec").collect()
    if not sample:
        return spark.createDataFrame([], result)
    pivots = _unit(np.frombuffer(b"".join(bytes(r["vec"]) for r in sample), np.float64).reshape(-1, dim))
    index = materialize(build_index(found, dim, pivots), "index")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids, x = _usable(batch, dim)
            yield {"query_id": ids, "query": [v.tobytes() for v in x]}
    asked = materialize(in_batches(narrow(queries), ask, "query_id long, query binary").distinct(), "queries")
    # Equal query vectors are searched once. Blocks of distinct ones pass through the driver one at a time.
    numbered = materialize(asked.select("query").distinct().withColumn("_n", F.xxhash64("query")), "distinct_queries")
    n_blocks = max(1, -(-numbered.count() // QUERY_BLOCK))
    parts = []
    for b in range(n_blocks):
        block = [bytes(r["query"]) for r in numbered.where(F.pmod("_n", F.lit(n_blocks)) == b).collect()]
        if block:
            parts.append(materialize(_search(index, block, dim, pivots, k + 1), "found"))
    if not parts:
        return spark.createDataFrame([], result)
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionAll(p)
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = (hits.select("query", "score", F.explode("ids").alias("vec_id"))
            .withColumn("_r", F.row_number().over(by_query)).where(F.col("_r") <= k + 1))
    by_id = Window.partitionBy("query_id").orderBy("_r")
    return (asked.join(best, "query").where(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
