"""Latent Dirichlet allocation over a vocabulary of any size.

Topics are a table with one row per term (idx, weights: one per topic), never held whole on the driver or in
a task. Rows are packed into blocks of a bounded number of cells, each with a dictionary of its own terms. An update
sends the weights of a term once to every block that holds it, fits each row's mixture there by variational steps, and
adds up what every term owes to each topic: once per block and term, not per cell. Tables are stored between updates, so a
lost executor costs one update at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import term_counts
from textmill.operators.features import build_vocabulary
from textmill.operators.ranking import top_per_group
from textmill.runtime import materialize, small_table

CELLS = "idx long, weights array<double>"
# Cells of a block, unless one row has more, and cells whose mixtures are fitted at once.
BLOCK_CELLS = 300_000
FIT_CELLS = 16_384
# Blocks of a stored file: it is written, and read, as one batch.
FILE_BLOCKS = 4


def digamma(x: np.ndarray) -> np.ndarray:
    """The logarithmic derivative of the gamma function, for positive arguments."""
    out = np.zeros_like(x)
    for k in range(6):
        out -= 1.0 / (x + k)
    y = x + 6.0
    z = 1.0 / (y * y)
    return out + np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z / 252))


def term_cells(df: DataFrame, vocab: DataFrame, terms: str = "terms") -> DataFrame:
    """(row, idx, n), stored: how often each vocabulary term occurs in each row."""
    rows = materialize(df.select(F.monotonically_increasing_id().alias("row"), term_counts(terms).alias("e")), "rows")
    each = rows.select("row", F.explode("e").alias("e")).select("row", "e.term", "e.n")
    return materialize(each.join(vocab.select("term", "idx"), "term").select(
        "row", F.col("idx").cast("bigint").alias("idx"), "n"), "cells")


@dataclass
class TermBlocks:
    """Rows packed into blocks, stored: `blocks` (block, row, size, pos, n) has the ids and sizes of a block's rows and, row by
    row, the places of their terms in the block's dictionary and their counts; `links` (block, pos, idx) has the dictionaries."""

    blocks: DataFrame
    links: DataFrame


def _pack(keys: pa.DataType):
    """Arrow batches of (row, e: array of (key, n)) to blocks with their dictionaries; rows without cells are left out."""
    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        lists = [p.column("e") for p in parts]
        cells = [x.flatten() for x in lists]
        codes = pa.chunked_array([c.field(0) for c in cells], keys).combine_chunks().dictionary_encode()
        columns = {
            "row": pa.concat_arrays([p.column("row") for p in parts]),
            "size": pa.concat_arrays([x.value_lengths().cast(pa.int32()) for x in lists]),
            "pos": codes.indices.cast(pa.int32()),
            "n": pa.concat_arrays([c.field(1) for c in cells]).cast(pa.int64()),
            "keys": codes.dictionary,
        }
        one = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns.values()]
        return pa.RecordBatch.from_arrays([columns["row"].slice(0, 1), *one], ["block", *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            sizes = batch.column("e").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(sizes > 0))
            ends = np.cumsum(sizes[sizes > 0])
            at, before = 0, 0
            while at < len(ends):
                # As many rows as fit, one at least.
                stop = int(np.searchsorted(ends, before + BLOCK_CELLS - held, "right"))
                if stop == at and not parts:
                    stop = at + 1
                if stop > at:
                    parts.append(batch.slice(at, stop - at))
                    held += int(ends[stop - 1]) - before
                    at, before = stop, int(ends[stop - 1])
                if at < len(ends) or held >= BLOCK_CELLS:
                    yield block(parts)
                    parts, held = [], 0
        if parts:
            yield block(parts)
    return run


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """Stored blocks of (row, e), with their dictionaries as `keys`. A block is named by its first row."""
    packed = rows.mapInArrow(_pack(pa.int64() if key == "bigint" else pa.string()),
                             f"block long, row array<long>, size array<int>, pos array<int>, n array<long>, keys array<{key}>")
    return materialize(packed, "blocks", FILE_BLOCKS)


def term_blocks(df: DataFrame, vocab: DataFrame, terms: str = "terms", row: Column | None = None) -> TermBlocks:
    """The counts of each row's vocabulary terms, packed. Only the dictionaries are shuffled. `row` numbers the rows, each once."""
    row = F.monotonically_increasing_id() if row is None else row
    rows = df.select(row.alias("row"), term_counts(terms).alias("e"))
    blocks = _blocks(rows, "string")
    each = blocks.select("block", F.posexplode("keys").alias("pos", "term"))
    links = each.join(vocab.select("term", F.col("idx").cast("bigint").alias("idx")), "term").select("block", "pos", "idx")
    return TermBlocks(blocks.drop("keys"), materialize(links, "links"))


def pack_cells(cells: DataFrame) -> TermBlocks:
    """Blocks of cells (row, idx, n) in any order."""
    # In the order of the terms, so that sums do not depend on the shuffle.
    of_row = F.array_sort(F.collect_list(F.struct(F.col("idx").cast("bigint").alias("idx"), F.col("n").cast("bigint").alias("n"))))
    blocks = _blocks(cells.groupBy(F.col("row").cast("bigint").alias("row")).agg(of_row.alias("e")), "bigint")
    links = blocks.select("block", F.posexplode("keys").alias("pos", "idx"))
    return TermBlocks(blocks.drop("keys"), materialize(links, "links"))


def _packed(cells: DataFrame | TermBlocks) -> TermBlocks:
    return cells if isinstance(cells, TermBlocks) else pack_cells(cells)


def start_topics(vocab: DataFrame, k: int, seed: int) -> DataFrame:
    """(idx, weights): 0.5 to 1.5 by a hash of term, topic and seed, so that a run can be repeated."""
    def draw(topic: Column) -> Column:
        mark = F.md5(F.concat_ws("|", "term", topic.cast("string"), F.lit(str(seed))))
        return 0.5 + F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return vocab.select(F.col("idx").cast("bigint").alias("idx"), F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)), draw).alias("weights"))


def start_near_one(vocab: DataFrame, k: int, seed: int) -> DataFrame:
    """(idx, weights): draws of the gamma distribution of shape 100 and mean 1, by the cube of a normal draw from a hash."""
    def draw(topic: Column) -> Column:
        mark = F.md5(F.concat_ws("|", "term", topic.cast("string"), F.lit(str(seed))))
        a, b = (F.conv(F.substring(mark, i, 8), 16, 10).cast("double") / float(1 << 32) for i in (1, 9))
        normal = F.sqrt(-2 * F.log(1 - a)) * F.cos(2 * math.pi * b)
        return F.pow(1 - 1 / 900 + normal / 30, F.lit(3.0))
    return vocab.select(F.col("idx").cast("bigint").alias("idx"), F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)), draw).alias("weights"))


def blend_topics(old: DataFrame, new: DataFrame, rate: float, eta: float) -> DataFrame:
    """The old weights moved towards the new ones; a term that no row has moves towards `eta`."""
    both = old.join(new.withColumnRenamed("weights", "_new"), "idx", "left")
    moved = F.zip_with("weights", F.coalesce("_new", F.transform("weights", lambda _: F.lit(eta))),
                       lambda a, b: (1 - rate) * a + rate * b)
    return both.select("idx", moved.alias("weights"))


def topic_totals(topics: DataFrame, k: int) -> np.ndarray:
    return np.array(topics.agg(*[F.sum(F.get("weights", F.lit(t))).alias(f"t{t}") for t in range(k)]).first(), float)


def _matrix(lists: pa.Array, k: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _arrays(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def _log_weights(totals: np.ndarray, k: int):
    """Weights to the exponential of their expected logarithm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                e = np.exp(digamma(_matrix(batch.column("weights"), k)) - digamma(totals))
                yield pa.RecordBatch.from_arrays([batch.column("idx"), _arrays(e)], ["idx", "weights"])
    return run


def exp_digamma(x: np.ndarray) -> np.ndarray:
    """exp(digamma(x)): the same series, the six shifts as one fraction, no logarithm."""
    u = x * (x + 5.0)
    shifts = (2.0 * x + 5.0) * ((3.0 * u + 20.0) * u + 24.0) / (u * ((u + 10.0) * u + 24.0))
    y = x + 6.0
    z = 1.0 / (y * y)
    return y * np.exp(-0.5 / y - z * (1 / 12 - z * (1 / 120 - z / 252)) - shifts)


def fit_rows(n: np.ndarray, e: np.ndarray, sizes: np.ndarray, alpha: float, steps: int, tolerance: float
             ) -> tuple[np.ndarray, np.ndarray]:
    """Mixtures (unnormalised) of rows, and what each cell owes to each topic.

    `n` and `e` hold the cells of all rows in turn, `sizes` how many a row has (one at least). A
    row stops when its mixture moves less than `tolerance` on average, whatever the others do.
    """
    k = e.shape[1]
    owed, mix = np.empty_like(e), np.empty((len(sizes), k))
    begin = np.cumsum(sizes) - sizes
    # Topics first: sums over a row run along memory.
    now = np.repeat(alpha + np.add.reduceat(n, begin)[None, :] / k, k, axis=0)
    e = np.ascontiguousarray(e.T)
    # Rows and cells still worked on, and which of these rows are open.
    rows, cells, open_ = np.arange(len(sizes)), np.arange(len(n)), np.ones(len(sizes), bool)
    row = np.repeat(rows, sizes)
    for step in range(steps):
        # What a row's mixture adds up to cancels out below.
        part = np.take(exp_digamma(now), row, axis=1)
        part *= e
        part *= n / (part.sum(axis=0) + 1e-100)
        new = alpha + np.add.reduceat(part, begin, axis=1)
        ends = open_ & ((np.abs(new - now).mean(axis=0) < tolerance) | (step == steps - 1))
        now = new
        if ends.any():
            mix[rows[ends]] = new[:, ends].T
            of = ends[row]
            owed[cells[of]] = part[:, of].T
            open_ &= ~ends
            if not open_.any():
                break
            if 4 * np.count_nonzero(open_) < 3 * len(open_):
                of = open_[row]
                n, e, cells, rows, now, sizes = n[of], e[:, of], cells[of], rows[open_], now[:, open_], sizes[open_]
                begin, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
                open_ = np.ones(len(sizes), bool)
    return mix, owed


def _fit_block(packed: pa.Table, sent: pa.Table, k: int, alpha: float, steps: int, tolerance: float, add=None
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows of a block that have a vocabulary term: whether a row has one, mixtures, and the index of every place (-1: not in
    the vocabulary). `add` gets the places of some cells and what they owe, batch by batch, so that no array has k numbers
    for every cell of the block."""
    size, pos, n = (packed.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("size", "pos", "n"))
    place = sent.column("pos").to_numpy()
    idx = np.full(int(pos.max()) + 1, -1, np.int64)
    idx[place] = sent.column("idx").to_numpy()
    weights = np.zeros((len(idx), k))
    at = 0
    for chunk in sent.column("weights").chunks:
        weights[place[at:at + len(chunk)]] = _matrix(chunk, k)
        at += len(chunk)
    known = idx[pos] >= 0
    if not known.all():
        size = np.bincount(np.repeat(np.arange(len(size)), size)[known], minlength=len(size))
        pos, n = pos[known], n[known]
    has = size > 0
    size = size[has]
    ends = np.cumsum(size)
    mix = np.empty((len(size), k))
    at, first = 0, 0
    while at < len(size):
        stop = max(at + 1, int(np.searchsorted(ends, first + FIT_CELLS, "right")))
        last = int(ends[stop - 1])
        mix[at:stop], owed = fit_rows(n[first:last].astype(float), weights[pos[first:last]], size[at:stop], alpha, steps, tolerance)
        if add is not None:
            add(pos[first:last], owed, len(idx))
        at, first = stop, last
    return has, mix, idx


class _Sums:
    """What the places of a block owe to each topic, added up."""

    def __init__(self):
        self.sums = None

    def add(self, pos: np.ndarray, owed: np.ndarray, places: int) -> None:
        if self.sums is None:
            self.sums = np.zeros((places, owed.shape[1]))
        order = np.argsort(pos, kind="stable")
        some, first = np.unique(pos[order], return_index=True)
        self.sums[some] += np.add.reduceat(owed[order], first)


def _fit(cells: DataFrame | TermBlocks, topics: DataFrame, k: int, columns: list[str], run, schema: str) -> DataFrame:
    """`run` on every block and the weights of its terms."""
    packed = _packed(cells)
    e = topics.mapInArrow(_log_weights(topic_totals(topics, k), k), CELLS)
    sent = packed.links.join(e, "idx").select("block", "pos", "idx", "weights")
    return packed.blocks.select("block", *columns).groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, schema)


def update_topics(cells: DataFrame | TermBlocks, topics: DataFrame, k: int, alpha: float, eta: float, steps: int = 100,
                  tolerance: float = 1e-3) -> DataFrame:
    """The topics after one pass over all rows, given as cells (row, idx, n) or packed."""
    def run(packed: pa.Table, sent: pa.Table) -> pa.Table:
        if not sent.num_rows:
            return pa.table({"idx": pa.array([], pa.int64()), "weights": pa.array([], pa.list_(pa.float64()))})
        found = _Sums()
        _, _, idx = _fit_block(packed, sent, k, alpha, steps, tolerance, found.add)
        some = idx >= 0
        sums = found.sums if some.all() else found.sums[some]
        return pa.table({"idx": pa.array(idx[some]), "weights": _arrays(sums)})

    each = _fit(cells, topics, k, ["size", "pos", "n"], run, CELLS)
    sums = [F.sum(F.get("weights", F.lit(t))).alias(f"t{t}") for t in range(k)]
    return each.groupBy("idx").agg(*sums).select("idx", F.array(*[F.col(f"t{t}") + eta for t in range(k)]).alias("weights"))


def train_topic_table(cells: DataFrame | TermBlocks, vocab: DataFrame, k: int = 10, seed: int = 42, max_iter: int = 10,
                      alpha: float | None = None, eta: float | None = None, online: bool = False) -> DataFrame:
    """(idx, weights) after `max_iter` updates, for stored `cells` (row, idx, n), or the same packed, and `vocab` (term, idx).

    With `online`, update t goes only the (1024 + t)^-0.51th part of the way, and starts near one: the steps of
    the library's online solver, but that each of them has every row once.
    """
    cells = _packed(cells)
    alpha, eta = 1.0 / k if alpha is None else alpha, 1.0 / k if eta is None else eta
    topics = materialize((start_near_one if online else start_topics)(vocab, k, seed), "topics")
    for t in range(1, max_iter + 1):
        new = update_topics(cells, topics, k, alpha, eta)
        topics = materialize(blend_topics(topics, new, (1024 + t) ** -0.51, eta) if online else new, "topics")
    return topics


def topic_mixtures(cells: DataFrame | TermBlocks, topics: DataFrame, k: int, alpha: float | None = None) -> DataFrame:
    """(row, mixture): the share of each topic in every row that has a vocabulary term."""
    alpha = 1.0 / k if alpha is None else alpha

    def run(packed: pa.Table, sent: pa.Table) -> pa.Table:
        if not sent.num_rows:
            return pa.table({"row": pa.array([], pa.int64()), "mixture": pa.array([], pa.list_(pa.float64()))})
        has, mix, _ = _fit_block(packed, sent, k, alpha, 100, 1e-3)
        row = packed.column("row").combine_chunks().flatten().filter(pa.array(has))
        return pa.table({"row": row, "mixture": _arrays(mix / mix.sum(axis=1, keepdims=True))})
    return _fit(cells, topics, k, ["row", "size", "pos", "n"], run, "row long, mixture array<double>")


def top_topic_words(topics: DataFrame, vocab: DataFrame, k: int, n: int = 10) -> DataFrame:
    """(topic, rank, term, weight): the heaviest terms of each topic, as shares of it; ties in term order."""
    totals = F.array(*[F.lit(float(t)) for t in topic_totals(topics, k)])
    each = topics.select("idx", F.posexplode("weights").alias("topic", "w")).select(
        "topic", "idx", (F.col("w") / F.get(totals, F.col("topic"))).alias("weight"))
    # Only terms no lighter than the n-th of a topic are named.
    least = top_per_group(each, ["topic"], [F.desc("weight"), F.asc("idx")], n).groupBy("topic").agg(F.min("weight").alias("least"))
    heavy = small_table(each.join(small_table(least), "topic").filter(F.col("weight") >= F.col("least")).drop("least"))
    each = heavy.join(vocab.select(F.col("idx").cast("bigint").alias("idx"), "term"), "idx").select("topic", "term", "weight")
    order = [F.desc("weight"), F.asc("term")]
    best = top_per_group(each, ["topic"], order, n)
    return best.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("m"), "term"))).alias("w")).select(
        "topic", F.posexplode("w").alias("rank", "e")).select(
        "topic", (F.col("rank") + 1).alias("rank"), "e.term", (-F.col("e.m")).alias("weight"))


def topics_of(df: DataFrame, terms: str = "terms", k: int = 10, n: int = 10, seed: int = 42, max_iter: int = 10
              ) -> tuple[DataFrame, DataFrame]:
    """((idx, weights), (topic, rank, term, weight)) over all terms of a table."""
    vocab = materialize(build_vocabulary(df, terms, None), "vocab")
    topics = train_topic_table(term_blocks(df, vocab, terms), vocab, k, seed, max_iter)
    return topics, top_topic_words(topics, vocab, k, n)
