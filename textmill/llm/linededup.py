"""Line dedup with Bloom filters for lines seen once and seen twice.

1. Every task turns its documents' line keys into filter positions and keeps those it saw
   once and those it saw twice. The positions are dealt out by filter segment; a task
   per segment adds them to the once-seen filter, and what was there already
   to the twice-seen filter. A key in two documents has all its positions in the latter.
2. Only keys that pass the twice-seen filter are suspected. They are counted exactly by a
   128-bit digest, combined per task before the shuffle, so a line of every document is
   one row per task. The smallest (document, line) of a key is found along the way.
3. Keys in at least `min_docs` documents are repeated: their lines go, or all but the
   first. Up to `SMALL_KEYS` repeated keys are sent to the tasks; more are joined
   to the suspected lines, and each text gets just the keys it holds.

The filter has a fixed size. If the corpus outgrows it more keys are suspected, which
costs shuffle but not exactness.

Null and empty texts are one empty line. Keys shorter than `min_key` code points
are never dropped. Repeated rows count as documents of their own; with
`keep_first`, rows with the document id of the first occurrence keep it. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import in_batches
from textmill.runtime import materialize

SPACES = b" \t\n\x0b\x0c\r"
FILTER_BITS = 27
SEGMENT_BITS = 21
PROBES = 2
# Repeated keys that are sent to the tasks (about 40 MB in a Python worker).
SMALL_KEYS = 300_000
# Keys that a task collects before it passes them on.
FLUSH = 1_000_000


def line_keys(text: str | None, min_key: int) -> list[bytes | None]:
    """The key of every line; None where the key is too short to be dropped."""
    keys = [x.strip(SPACES).lower() for x in (text or "").encode().split(b"\n")]
    if min_key <= 1:
        return [k or None for k in keys] if min_key == 1 else keys
    return [k if len(k) >= min_key and len(k.decode()) >= min_key else None for k in keys]


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Filter positions of 64-bit hashes, one column per probe."""
    mask = np.uint64((1 << bits) - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask], axis=1).astype(np.int64)


def passes(seen: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all positions of a row are set in a packed filter."""
    return ((seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def _hashes(keys: set[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def twice_seen(docs: DataFrame, text: str, min_key: int, bits: int = FILTER_BITS) -> np.ndarray:
    """The twice-seen filter over all documents, packed."""
    segment = min(SEGMENT_BITS, bits)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def passed_on(parts: list[np.ndarray]) -> dict:
            # A position counts once per key and document; two different keys there make it suspect, no more.
            at, n = np.unique(positions(np.concatenate(parts), bits).ravel(), return_counts=True)
            seg = at >> segment
            cuts = np.flatnonzero(np.diff(seg, prepend=-1))
            return {"segment": seg[cuts], **{name: [
                (p[keep] & ((1 << segment) - 1)).astype("<u4").tobytes()
                for p, keep in ((at[a:b], pick(n[a:b])) for a, b in zip(cuts, [*cuts[1:], len(at)]))]
                for name, pick in (("once", lambda c: c == 1), ("twice", lambda c: c > 1))}}

        parts, held = [], 0
        for batch in batches:
            for t in batch.column(0):
                keys = set(line_keys(t.as_py(), min_key))
                keys.discard(None)
                if keys:
                    parts.append(_hashes(keys))
                    held += len(keys)
                if held >= FLUSH:
                    yield passed_on(parts)
                    parts, held = [], 0
        if parts:
            yield passed_on(parts)

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(1 << segment, bool), np.zeros(1 << segment, bool)
        for a, b in zip(frame["once"], frame["twice"]):
            first, more = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
            twice[first[once[first]]] = True
            twice[more] = True
            once[first] = once[more] = True
        return pd.DataFrame({"segment": frame["segment"][:1], "seen": [np.packbits(twice, bitorder="little").tobytes()]})

    rows = (in_batches(docs.select(text), local, "segment long, once binary, twice binary")
            .groupBy("segment").applyInPandas(merged, "segment long, seen binary").collect())
    seen = np.zeros((1 << bits) >> 3, np.uint8)
    for r in rows:
        part = np.frombuffer(r["seen"], np.uint8)
        seen[r["segment"] * len(part):(r["segment"] + 1) * len(part)] = part
    return seen


def repeated_keys(docs: DataFrame, doc_id: str, text: str, min_docs: int, min_key: int,
                  seen: Callable[[], np.ndarray], bits: int) -> DataFrame:
    """`digest, n_docs, first` (document, line) of every key in at least `min_docs` documents."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        filter_ = seen()

        def passed_on(found: dict) -> dict:
            return {"digest": list(found), **{c: [v[i] for v in found.values()]
                                              for i, c in enumerate(("n", "first_doc", "first_line"))}}

        found: dict[bytes, list] = {}
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines: dict[bytes, int] = {}
                for i, k in enumerate(line_keys(t.as_py(), min_key)):
                    if k is not None:
                        lines.setdefault(k, i)
                if not lines:
                    continue
                keys = list(lines)
                for j in np.flatnonzero(passes(filter_, positions(_hashes(keys), bits))):
                    digest, line = xxhash.xxh3_128_digest(keys[j]), lines[keys[j]]
                    old = found.get(digest)
                    if old is None:
                        found[digest] = [1, d, line]
                    else:
                        old[0] += 1
                        # Null ids come first, as in Spark's order.
                        if (d is not None, d or 0, line) < (old[1] is not None, old[1] or 0, old[2]):
                            old[1:] = d, line
            if len(found) >= FLUSH:
                yield passed_on(found)
                found = {}
        if found:
            yield passed_on(found)

    return (in_batches(docs.select(F.col(doc_id).cast("bigint").alias("d"), text), local,
                       "digest binary, n long, first_doc long, first_line long")
            .groupBy("digest").agg(F.sum("n").alias("n_docs"), F.min(F.struct("first_doc", "first_line")).alias("first"))
            .where(F.col("n_docs") >= min_docs))


def _suspected(docs: DataFrame, text: str, min_key: int, seen: Callable[[], np.ndarray], bits: int) -> DataFrame:
    """(`_text_key`, digest) of the suspected keys of every text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        filter_ = seen()
        for batch in batches:
            of, digests = [], []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = list({k for k in line_keys(t.as_py(), min_key) if k is not None})
                if keys:
                    for j in np.flatnonzero(passes(filter_, positions(_hashes(keys), bits))):
                        of.append(key)
                        digests.append(xxhash.xxh3_128_digest(keys[j]))
            yield {"_text_key": of, "digest": digests}
    return in_batches(docs.select("_text_key", text), work, "_text_key long, digest binary").distinct()


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10, min_key: int = 1,
               keep_first: bool = False, keep: list[str] | None = None, bits: int = FILTER_BITS,
               small_keys: int = SMALL_KEYS) -> DataFrame:
    """For every row: the columns `keep`, n_lines, n_dropped and kept (the text without the dropped lines)."""
    spark = docs.sparkSession
    keep = [doc_id] if keep is None else keep
    sent = spark.sparkContext.broadcast(twice_seen(docs, text, min_key, bits))
    keys = materialize(repeated_keys(docs, doc_id, text, min_docs, min_key, lambda: sent.value, bits), "repeated")
    few = keys.limit(small_keys + 1).count() <= small_keys
    rows = docs.select(*keep, F.col(doc_id).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    if few:
        found = spark.sparkContext.broadcast({bytes(r["digest"]): (r["first"]["first_doc"], r["first"]["first_line"])
                                              for r in keys.collect()})
    else:
        # Texts with the same hash share their keys; a key too many in such a set does no harm.
        rows = rows.withColumn("_text_key", F.xxhash64("_text"))
        of_text = (_suspected(rows, "_text", min_key, lambda: sent.value, bits).join(keys, "digest")
                   .groupBy("_text_key").agg(F.collect_list(F.struct("digest", "first")).alias("_keys")))
        rows = rows.join(of_text, "_text_key", "left").drop("_text_key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            kept, n, gone = [], [], []
            ids = batch.column("_id").to_pylist()
            own = None if few else batch.column("_keys").to_pylist()
            for r, t in enumerate(batch.column("_text")):
                t = t.as_py() or ""
                table = found.value if few else {
                    k["digest"]: (k["first"]["first_doc"], k["first"]["first_line"]) for k in own[r] or ()}
                lines, out, cache = t.split("\n"), [], {}
                if table:
                    for i, (line, k) in enumerate(zip(lines, line_keys(t, min_key))):
                        if k not in cache:
                            cache[k] = None if k is None else table.get(xxhash.xxh3_128_digest(k))
                        first = cache[k]
                        if first is None or keep_first and first == (ids[r], i):
                            out.append(line)
                else:
                    out = lines
                n.append(len(lines))
                gone.append(len(lines) - len(out))
                kept.append("\n".join(out))
            yield {**{c: batch.column(c) for c in keep}, "n_lines": n, "n_dropped": gone, "kept": kept}

    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
        T.StructField("kept", T.StringType())])
    return in_batches(rows, work, schema)


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars",
                        min_docs: int = 10, **options) -> DataFrame:
    """`docs` with its columns, its texts without the repeated lines, and their new length where it has that column."""
    # The row travels as a struct, so that its names cannot clash with the ones made here.
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("_of"), F.col(text).alias("_in"))
    out = line_dedup(rows, "_of", "_in", min_docs, keep=["row"], **options)
    new = {text: F.col("kept"), n_chars: F.char_length("kept").cast("bigint")}
    return out.select(*((new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns))
