"""Suffix-array dedup: every byte of a passage that also starts earlier goes.

A passage is a window of `WINDOW` bytes inside one document. The suffixes of the corpus are sorted to that
depth, equal ones become neighbours, and all but the earliest are marked. To sort
suffixes in many tasks, and only those that can have a twin:

1. Documents are stored in compressed blocks, bucketed by block: codes and marks come to the texts, which are never
   shuffled. A window's *anchor* is the least hash of its 16-byte
   strings (the leftmost, if equal), so equal windows have equal anchors, at the same
   place. About one byte in forty is an anchor; the windows of an anchor are consecutive.
2. Anchors are counted over the corpus, once per distinct surrounding and block. An anchor met once
   has no window that repeats. Only the text around the others, a *slice* that holds
   all windows of one anchor, is sent to the task of that anchor. Equal slices of a block are sent once.
3. In a task, equal slices fall together first; all but the earliest are repeated as a whole. The suffixes of
   the slices that differ are sorted by deep-shallow sorting: multikey quicksort by 8-byte words to a shallow
   depth; what is then still together has a long common prefix, and is ordered
   by blind tries, which are grown for all such groups at once: a leaf of each node is compared
   with the node's other members once, and the first difference says where they branch off.
4. The marked windows return to their blocks, whose bytes are cut.

An anchor with more than `HOT_SLICES` slices, counted once per block, would make too large a group. The earliest of
each of its windows is found by a Spark aggregation over 128-bit digests, which is combined before
the shuffle; dearer, but no group is ever gathered.

Documents are ordered by id (null first), then by a hash of the text; rows equal in both are the same
document and get the same result. Null and empty texts have no bytes. Texts shorter than the window never
change. What is left may not be valid UTF-8, so it is binary. An empty table gives an empty result.
The columns `keep` travel as one struct and cannot clash with others.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import in_batches
from textmill.runtime import materialize, materialize_bucketed

WINDOW = 100
GRAM = 16
# Bytes of text in a block; a longer document is a block of its own.
BLOCK_BYTES = 2_000_000
BLOCK_ROWS = 2_000
# Windows whose anchors are found at once; their places take the low bits of a hash.
STRETCH = 1 << 18
# Bytes of text whose anchors make one group.
SEGMENT_BYTES = 64_000_000
HOT_SLICES = 20_000
# Suffixes that are sorted at once.
SORTED_AT_ONCE = 500_000
SHALLOW_WORDS = 2

_U = np.uint64


def _words(buf: bytes) -> np.ndarray:
    """The 8 bytes from every place as one big-endian number; needs 8 bytes of padding behind the text."""
    return np.ndarray((len(buf) - 7,), ">u8", buf, strides=(1,))


def gram_hashes(buf: bytes, a: int, b: int) -> np.ndarray:
    """A hash of the 16 bytes from each place a to b - 1."""
    w = _words(buf)
    h = w[a:b].astype(_U) * _U(0x9E3779B97F4A7C15)
    h ^= w[a + 8:b + 8].astype(_U) * _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """The minimum of each `n` consecutive values."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x if size == n else np.minimum(x[:len(x) - (n - size)], x[n - size:])


def anchor_runs(buf: bytes, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """anchor, place, first and last start of the windows of each anchor; `buf` is padded by 16 bytes."""
    size, grams = int(ends[-1]) if len(ends) else 0, window - GRAM + 1
    parts = []
    low = _U(STRETCH * 2 - 1)
    for a in range(0, size - window + 1, STRETCH):
        b = min(a + STRETCH, size - window + 1)
        h = gram_hashes(buf, a, b + grams - 1)
        least = sliding_least(h & ~low | np.arange(len(h), dtype=_U), grams)
        at = (least & low).astype(np.int64)
        starts = np.arange(a, b)
        inside = starts + window <= ends[np.searchsorted(ends, starts, "right")]
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1]), [True]]))
        first, last = cut[:-1], cut[1:] - 1
        ok = inside[first]
        first, last = first[ok], last[ok]
        parts.append((h[at[first]], at[first] + a, first + a, last + a))
    if not parts:
        return tuple(np.zeros(0, t) for t in (_U, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(p) for p in zip(*parts))


def slice_marks(buf: bytes, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """A hash of each slice, equal for equal slices."""
    w = _words(buf)
    end = last + window - 8
    out = (last - first).astype(_U)
    for k in range(0, 2 * window, 8):
        out = (out ^ w[np.minimum(first + k, end)].astype(_U)) * _U(0x9FB21C651E98DF25)
        out ^= out >> _U(35)
    return out


# Sorting

def deep_shallow(buf: bytes, starts: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the strings of `depth` bytes from `starts` within their groups.

    Gives the order, and whether a string in this order equals the one before it. `buf` is padded by 8 bytes.
    """
    w = _words(buf)
    order = np.argsort(group, kind="stable")
    # Slots of `order`: `opens` marks the first of each part that is still together.
    g = group[order]
    opens = np.concatenate([[True], g[1:] != g[:-1]])
    slots = np.arange(len(order))
    for level in range(min(SHALLOW_WORDS, depth // 8)):
        part = np.cumsum(opens)[slots]
        word = w[starts[order[slots]] + 8 * level].astype(_U)
        by = np.lexsort((word, part))
        order[slots], part, word = order[slots][by], part[by], word[by]
        opens[slots[1:]] |= word[1:] != word[:-1]
        slots = _together(opens, slots)
        if not len(slots):
            break
    shallow = 8 * min(SHALLOW_WORDS, depth // 8)
    return order, _blind_tries(w, starts, order, opens, slots, shallow, depth)


def _together(opens: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Those slots whose part has two members or more."""
    more = np.concatenate([~opens[1:], [False]])
    return slots[~opens[slots] | more[slots]]


def _blind_tries(w: np.ndarray, starts: np.ndarray, order: np.ndarray, opens: np.ndarray, slots: np.ndarray,
                 common: int, depth: int) -> np.ndarray:
    """Order what is left in parts with `common` equal bytes; says which slots equal the one before."""
    equal = np.zeros(len(order), bool)
    while len(slots):
        head = opens[slots]
        mine = order[slots]
        leaf = mine[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        # Where a string leaves its leaf's path, on which side, and by which byte.
        lcp, side, byte = np.full(len(slots), depth), np.zeros(len(slots), np.int64), np.zeros(len(slots), np.uint64)
        rest = np.flatnonzero(~head)
        for k in [*range(common, depth - 8, 8), depth - 8]:
            x, y = w[starts[mine[rest]] + k].astype(_U), w[starts[leaf[rest]] + k].astype(_U)
            differs = x != y
            at, x, y = rest[differs], x[differs], y[differs]
            zeros, d = np.zeros(len(at), np.uint64), x ^ y
            for bits in (32, 16, 8):
                high = (d >> _U(64 - bits)) == 0
                zeros += high * _U(bits)
                d = np.where(high, d << _U(bits), d)
            lcp[at] = k + (zeros >> _U(3)).astype(np.int64)
            byte[at] = (x >> (_U(56) - zeros)) & _U(255)
            side[at] = np.where(x < y, -1, 1)
            rest = rest[~differs]
            if not len(rest):
                break
        # Smaller strings branch off from the top of the path down, larger ones from the bottom up.
        part = np.cumsum(head)
        by = np.lexsort((byte, -side * lcp, side, part))
        order[slots] = mine[by]
        lcp, side, byte, part = lcp[by], side[by], byte[by], part[by]
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (side[1:] != side[:-1]) | (lcp[1:] != lcp[:-1])
                              | (byte[1:] != byte[:-1])])
        opens[slots] = new
        whole = side == 0
        equal[slots[whole & ~new]] = True
        slots = _together(opens, slots[~whole])
    return equal


# The steps on Spark

def write_blocks(docs: DataFrame, doc_id: str, text: str, keep: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`block, n_bytes, ids, ends, text, rows`: texts joined and compressed, and the kept columns as an Arrow stream."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pack = zstandard.ZstdCompressor(level=3)
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> dict:
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks()
            texts = table.column("_text").to_pylist()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.select(keep).schema) as out:
                out.write_table(table.select(keep))
            number += 1
            joined = b"".join(texts)
            return {"block": [number], "n_bytes": [len(joined)], "ids": [table.column("_id").to_pylist()],
                    "ends": [np.cumsum([len(t) for t in texts], dtype="<i8").tobytes()],
                    "text": [pack.compress(joined)], "rows": [pack.compress(sink.getvalue().to_pybytes())]}

        for batch in batches:
            sizes = pc.binary_length(batch.column("_text")).to_numpy()
            a = 0
            for b, n in enumerate(sizes.tolist(), 1):
                size += n
                if size >= block_bytes or sum(len(h) for h in held) + b - a >= BLOCK_ROWS:
                    held.append(batch.slice(a, b - a))
                    yield block()
                    held, size, a = [], 0, b
            if a < len(sizes):
                held.append(batch.slice(a))
        if held:
            yield block()

    rows = docs.select(*keep, F.col(doc_id).cast("bigint").alias("_id"),
                       F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"))
    # As many as shuffles make, so that what is aggregated by block comes to the texts as it is.
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize_bucketed(in_batches(
        rows, work, "block long, n_bytes long, ids array<long>, ends binary, text binary, rows binary"), "blocks", "block", buckets)


def _open(text: bytes, ends: bytes) -> tuple[bytes, np.ndarray]:
    """The padded text of a block, and where its documents end."""
    return zstandard.ZstdDecompressor().decompress(text) + bytes(GRAM), np.frombuffer(ends, "<i8")


def _numbered(anchors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors of a block by segment, and each run's place among them."""
    distinct, of = np.unique(anchors, return_inverse=True)
    by = np.argsort(distinct % _U(segments), kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    return distinct[by], place[of]


def anchor_codes(blocks: DataFrame, segments: int, window: int, hot_slices: int) -> DataFrame:
    """`block, codes`: for the block's distinct anchors, by segment, 0 (met once), 1 (repeated) or 2 (hot)."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for number, text, ends in zip(*(batch.column(c) for c in ("block", "text", "ends"))):
                buf, stops = _open(text.as_py(), ends.as_py())
                runs, _, first, last = anchor_runs(buf, stops, window)
                if not len(runs):
                    continue
                anchors, of = _numbered(runs, segments)
                pairs = np.unique(np.stack([of.astype(_U), slice_marks(buf, first, last, window)]), axis=1)
                slices = np.bincount(pairs[0].astype(np.int64)).astype("<u4")
                slices |= (np.bincount(of) > 1).astype("<u4") << np.uint32(31)
                part = (anchors % _U(segments)).astype(np.int64)
                cut = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
                yield {"segment": part[cut[:-1]], "block": [number.as_py()] * (len(cut) - 1),
                       "anchors": [anchors[a:b].astype("<u8").tobytes() for a, b in zip(cut, cut[1:])],
                       "slices": [slices[a:b].tobytes() for a, b in zip(cut, cut[1:])]}

    def count(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(a.as_py(), "<u8") for a in table.column("anchors")]
        slices = np.concatenate([np.frombuffer(a.as_py(), "<u4") for a in table.column("slices")])
        _, of = np.unique(np.concatenate(sent), return_inverse=True)
        n = np.bincount(of, slices & np.uint32((1 << 31) - 1))
        repeated = (n > 1) | (np.bincount(of, slices >> np.uint32(31)) > 0)
        code = (repeated.astype(np.uint8) + (n > hot_slices))[of]
        ends = np.cumsum([len(a) for a in sent])
        return pa.table({"block": table.column("block"), "segment": table.column("segment"),
                         "codes": pa.array([c.tobytes() for c in np.split(code, ends[:-1])], pa.binary()),
                         "hot": pa.array([bool((c == 2).any()) for c in np.split(code, ends[:-1])])})

    codes = (in_batches(blocks.select("block", "text", "ends"), send,
                        "segment long, block long, anchors binary, slices binary")
             .groupBy("segment").applyInArrow(count, "block long, segment long, codes binary, hot boolean"))
    return materialize(codes.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("segment", "codes"))).alias("codes"), F.bool_or("hot").alias("hot")), "codes")


ENTRY = pa.schema([("anchor", pa.uint64()), ("has_id", pa.bool_()), ("id", pa.int64()), ("tie", pa.int64()),
                   ("at", pa.int64()), ("off", pa.int16()), ("first", pa.binary()), ("rest", pa.binary()),
                   ("slice", pa.binary())])
ORDER = ["has_id", "id", "tie", "at"]


def _bearers(batches: Iterator[pa.RecordBatch], segments: int, window: int, wanted: int) -> Iterator[tuple]:
    """For each block with its codes: number, padded text, who precedes whom, and the runs of anchors with that code."""
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("block", "ids", "text", "ends", "codes"))):
            number, ids, text, ends, parts = (c.as_py() for c in row)
            buf, stops = _open(text, ends)
            anchors, at, first, last = anchor_runs(buf, stops, window)
            code = np.frombuffer(b"".join(p["codes"] for p in parts), np.uint8)[_numbered(anchors, segments)[1]]
            some = np.flatnonzero(code == wanted)
            if len(some):
                begin = np.concatenate([[0], stops])
                docs = [(i is not None, i or 0, xxhash.xxh3_64_intdigest(buf[a:b]) - (1 << 63))
                        for i, a, b in zip(ids, begin.tolist(), stops.tolist())]
                of = np.searchsorted(stops, first[some], "right")
                yield number, buf, zip(*(x.tolist() for x in (anchors[some], at[some], first[some], last[some])),
                                       map(docs.__getitem__, of.tolist()), begin[of].tolist())


class Found:
    """Equal strings of a block: who has the string first (in document order), and where else it is."""

    def __init__(self):
        self.of: dict = {}

    def add(self, key, order: tuple, off: int, start: int) -> None:
        old = self.of.get(key)
        if old is None:
            self.of[key] = [order, off, [start], []]
        elif order == old[0]:
            old[2].append(start)
        elif order > old[0]:
            old[3].append(start)
        else:
            old[3] += old[2]
            old[0], old[2] = order, [start]

    def columns(self) -> dict[str, list]:
        entries = list(self.of.values())
        return {**{c: [e[0][i] for e in entries] for i, c in enumerate(ORDER)}, "off": [e[1] for e in entries],
                "first": [np.array(e[2], "<i8").tobytes() for e in entries],
                "rest": [np.array(e[3], "<i8").tobytes() for e in entries]}


def repeated_slices(blocks: DataFrame, codes: DataFrame, segments: int, window: int) -> DataFrame:
    """`segment, block, entries`: the text around repeated anchors, once per block, compressed by segment."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for number, buf, runs in _bearers(batches, segments, window, 1):
            found = Found()
            for h, p, s, e, doc, begin in runs:
                found.add((h, buf[s:e + window]), (*doc, p - begin), p - s, s)
            keys = list(found.of)
            table = pa.table({"anchor": [k[0] for k in keys], **found.columns(), "slice": [k[1] for k in keys]}, ENTRY)
            part = np.array([k[0] for k in keys], _U) % _U(segments)
            by = np.argsort(part, kind="stable")
            part = part[by].astype(np.int64)
            cut = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
            entries = []
            for a, b in zip(cut, cut[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                    out.write_table(table.take(by[a:b]).combine_chunks())
                entries.append(sink.getvalue().to_pybytes())
            yield {"segment": part[cut[:-1]], "block": [number] * len(entries), "entries": entries}

    return in_batches(blocks.select("block", "ids", "text", "ends").join(codes, "block"), work,
                      "segment long, block long, entries binary")


def late_hot_windows(blocks: DataFrame, codes: DataFrame, segments: int, window: int) -> DataFrame:
    """`block, marks` for the windows of hot anchors, by Spark's own aggregation over their digests."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for number, buf, runs in _bearers(batches, segments, window, 2):
            found = Found()
            for _, _, s, e, doc, begin in runs:
                for k in range(s, e + 1):
                    found.add(xxhash.xxh3_128_digest(buf[k:k + window]), (*doc, k - begin), 0, k)
            columns = found.columns()
            del columns["off"]
            yield {"digest": list(found.of), "block": [number] * len(found.of), **columns}

    rows = materialize(in_batches(
        blocks.select("block", "ids", "text", "ends").join(codes, "block"), work,
        "digest binary, block long, has_id boolean, id long, tie long, at long, first binary, rest binary"), "hot")
    order = F.struct(*ORDER)
    least = rows.groupBy("digest").agg(F.min(order).alias("least"))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            marks = Marks()
            for block, late, first, rest in zip(*(c.to_pylist() for c in batch.columns)):
                marks.add(block, rest + first if late else rest, 0, 1)
            yield marks.take()

    late = rows.join(least, "digest").select("block", (order > F.col("least")).alias("late"), "first", "rest")
    return in_batches(late, ranges, "block long, marks binary")


class Marks:
    """Ranges of window starts to be cut, by block."""

    def __init__(self):
        self.of: dict[int, list[int]] = defaultdict(list)

    def add(self, block: int, starts: bytes, a: int, b: int) -> None:
        """Windows a to b - 1 of every slice at `starts`."""
        out = self.of[block]
        for s in np.frombuffer(starts, "<i8").tolist():
            out += (s + a, s + b)

    def take(self) -> dict:
        of, self.of = self.of, defaultdict(list)
        return {"block": list(of), "marks": [np.array(m, "<i8").tobytes() for m in of.values()]}


class Sorter:
    """Collects the slices of anchors that have several, and sorts their windows together."""

    def __init__(self, marks: Marks, window: int):
        self.marks, self.window = marks, window
        self.clear()

    def clear(self) -> None:
        self.pieces, self.info, self.bearers, self.size, self.anchors = [], [], [], 0, 0

    def anchor(self, entries: list[tuple]) -> None:
        """All entries (order, off, block, first, rest, slice) of an anchor, in order."""
        found: dict[bytes, tuple] = {}
        rank, before = 0, None
        for order, off, block, first, rest, piece in entries:
            rank += order != before
            before = order
            n = len(piece) - self.window + 1
            self.marks.add(block, rest, 0, n)
            old = found.setdefault(piece, (rank, off, n, []))
            if old[0] == rank:
                old[3].append((block, first))
            else:
                self.marks.add(block, first, 0, n)
        if len(found) > 1:
            for piece, (rank, off, n, bearers) in found.items():
                self.pieces.append(piece)
                self.info.append((self.anchors, rank, off, n))
                self.bearers.append(bearers)
                self.size += n
            self.anchors += 1
            if self.size >= SORTED_AT_ONCE:
                self.sort()

    def sort(self) -> None:
        if not self.pieces:
            return
        anchor, rank, off, n = np.array(self.info, np.int64).T
        piece = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
        base = np.cumsum([0, *map(len, self.pieces[:-1])])
        # Equal windows have their anchor at the same place.
        group = anchor[piece] * self.window + off[piece] - k
        order, equal = deep_shallow(b"".join(self.pieces) + bytes(8), base[piece] + k, group, self.window)
        ranks = rank[piece[order]]
        heads = np.flatnonzero(~equal)
        least = np.repeat(np.minimum.reduceat(ranks, heads), np.diff([*heads, len(ranks)]))
        late = np.zeros(len(piece), bool)
        late[order] = ranks > least
        edge = np.flatnonzero(np.concatenate([[True], (late[1:] != late[:-1]) | (piece[1:] != piece[:-1]), [True]]))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if late[a]:
                for block, first in self.bearers[piece[a]]:
                    self.marks.add(block, first, int(k[a]), int(k[b - 1]) + 1)
        self.clear()


def late_windows(slices: DataFrame, window: int) -> DataFrame:
    """`block, marks`: ranges of the starts of windows that also start earlier."""
    def work(table: pa.Table) -> pa.Table:
        # The entries of a segment, whose size is bounded; only some rows at a time become Python objects.
        parts = [pa.ipc.open_stream(e.as_py()).read_all() for e in table.column("entries")]
        block = np.repeat(table.column("block").to_numpy(), [p.num_rows for p in parts])
        all_ = pa.concat_tables(parts).append_column("block", pa.array(block, pa.int64()))
        all_ = all_.sort_by([(c, "ascending") for c in ("anchor", *ORDER)])
        marks = Marks()
        sorter, held, entries = Sorter(marks, window), None, []
        for batch in all_.to_batches(max_chunksize=5_000):
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            for anchor, *entry in zip(columns["anchor"], zip(*(columns[c] for c in ORDER)),
                                      *(columns[c] for c in ("off", "block", "first", "rest", "slice"))):
                if anchor != held:
                    sorter.anchor(entries)
                    held, entries = anchor, []
                entries.append(tuple(entry))
        sorter.anchor(entries)
        sorter.sort()
        out = marks.take()
        return pa.table({"block": pa.array(out["block"], pa.int64()), "marks": pa.array(out["marks"], pa.binary())})

    return slices.groupBy("segment").applyInArrow(work, "block long, marks binary")


def cut_blocks(blocks: DataFrame, marks: DataFrame, schema: T.StructType, window: int) -> DataFrame:
    """The kept columns of every document, n_bytes, spans and kept."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for text, ends, rows, ranges in zip(*(batch.column(c) for c in ("text", "ends", "rows", "marks"))):
                buf, stops = _open(text.as_py(), ends.as_py())
                table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(rows.as_py())).read_all()
                gone = None
                if ranges.is_valid:
                    at = np.frombuffer(b"".join(ranges.as_py()), "<i8").reshape(-1, 2)
                    step = np.bincount(at[:, 0], minlength=len(buf)) - np.bincount(at[:, 1] + window - 1, minlength=len(buf))
                    gone = np.cumsum(step) > 0
                out = {"n_bytes": np.diff(stops, prepend=0), "n_removed": [], "spans": [], "kept": []}
                chars = np.frombuffer(buf, np.uint8)
                for a, b in zip([0, *stops.tolist()], stops.tolist()):
                    cut = gone[a:b] if gone is not None else None
                    if cut is None or not cut.any():
                        out["n_removed"].append(0)
                        out["spans"].append([])
                        out["kept"].append(buf[a:b])
                        continue
                    edges = np.flatnonzero(np.diff(cut, prepend=False, append=False)).reshape(-1, 2)
                    out["n_removed"].append(int(cut.sum()))
                    out["spans"].append([{"start": s, "end": e} for s, e in edges.tolist()])
                    out["kept"].append(chars[a:b][~cut].tobytes())
                yield {**{c: table.column(c).combine_chunks() for c in table.column_names}, **out}

    of_block = marks.groupBy("block").agg(F.collect_list("marks").alias("marks"))
    return in_batches(blocks.select("block", "text", "ends", "rows").join(of_block, "block", "left"), work, schema)


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                 window: int = WINDOW, block_bytes: int = BLOCK_BYTES, segment_bytes: int = SEGMENT_BYTES,
                 hot_slices: int = HOT_SLICES) -> DataFrame:
    """For every row: the columns `keep`, n_bytes, n_removed, spans (removed, in bytes of the text) and kept (binary)."""
    if window < 2 * GRAM:
        raise ValueError(f"the window must have {2 * GRAM} bytes or more")
    keep = [doc_id] if keep is None else keep
    blocks = write_blocks(docs, doc_id, text, keep, block_bytes)
    segments = 1 + (blocks.agg(F.sum("n_bytes")).first()[0] or 0) // segment_bytes
    segments = max(segments, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    codes = anchor_codes(blocks, segments, window, hot_slices)
    marks = late_windows(repeated_slices(blocks, codes.drop("hot"), segments, window), window)
    hot = codes.where("hot").drop("hot")
    if hot.limit(1).count():
        marks = marks.unionByName(late_hot_windows(blocks, hot, segments, window))
    marks = materialize(marks, "marks")
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                         T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])
    return cut_blocks(blocks, marks, schema, window)
