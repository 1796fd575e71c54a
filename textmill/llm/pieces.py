"""SentencePiece encoding and decoding on a relational lattice.

1. A text is normalised as the model says (a mark for each blank, one in front) and cut into
   *units* across which no piece reaches: marks and the signs behind them, apart from signs
   that occur in no longer piece. Distinct units of the corpus are gathered,
   combined per task before the shuffle.
2. *Lattice.* The substrings of each distinct unit up to the longest piece are exploded and joined
   to the piece table by equality; the matches are the edges, grouped by unit.
3. *Fold.* A Spark higher-order aggregate walks the lattice. For a unigram model it is Viterbi
   (`fold="viterbi"`: the path of the highest score). The scores of a BPE model are
   merge ranks, and the path of the highest sum is not what the model means; for such a
   model (`fold="merge"`, the default) the fold keeps the set of borders and
   takes, step by step, the edge of the best rank that spans exactly two parts.
4. Each text looks its units up: in a bounded broadcast table if the distinct units are few enough
   (`SENT_UNITS`), else each text is joined with the units that it holds.

Signs without a piece become their UTF-8 bytes. Null and empty texts have no ids. Repeated rows
are encoded one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import in_batches, let, most_frequent
from textmill.runtime import materialize

MARK = "▁"
# Units up to this length keep their borders in the bits of one long integer.
MASK_CHARS = 60
# Distinct units that are sent to the tasks at most: about 20 bytes each.
SENT_UNITS = 4_000_000
HOT_UNITS = 100_000
FLUSH = 150_000


class Model:
    """What a model file says: pieces with id and score, byte ids, and signs that longer pieces hold."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with the identity normalizer are supported")
        self.prefix = norm.add_dummy_prefix
        self.text = [p.piece for p in proto.pieces]
        self.pieces = [(p.piece, i, float(p.score)) for i, p in enumerate(proto.pieces) if p.type == p.NORMAL]
        byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == p.BYTE}
        self.bytes = [byte[b] for b in range(256)] if byte else [proto.trainer_spec.unk_id] * 256
        self.byte_of = {i: b for b, i in byte.items()}
        self.longest = max(len(p) for p, _, _ in self.pieces)
        inner = "".join(map(regex.escape, sorted({c for p, _, _ in self.pieces if len(p) > 1 for c in p} - {MARK})))
        # Marks belong to the signs behind them; a sign that no longer piece holds stands alone.
        self.units = regex.compile(f"{MARK}*[{inner}]+|{MARK}+|[^{inner}]" if inner else ".", regex.S).findall

    def normal(self, text: str) -> str:
        return (MARK if self.prefix else "") + text.replace(" ", MARK) if text else ""


@lru_cache(2)
def _model(path: str) -> Model:
    return Model(path)


def distinct_units(docs: DataFrame, path: str, text: str) -> DataFrame:
    """`unit, n` over all texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from collections import Counter
        m, found = _model(path), Counter()
        for batch in batches:
            for t in batch.column(0):
                found.update(m.units(m.normal(t.as_py() or "")))
                if len(found) >= FLUSH:
                    yield {"unit": list(found), "n": list(found.values())}
                    found = Counter()
        yield {"unit": list(found), "n": list(found.values())}
    return in_batches(docs.select(text), work, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def lattice(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """`unit, size, edges` (rank order: best score, then leftmost) of every unit; the unit's columns stay.

    The units are distinct and stay where they are: the piece table is bounded and broadcast, and
    the edges are gathered under the partitioning that the units came with.
    """
    size = F.char_length("unit")
    starts = units.withColumn("size", size).withColumn("s", F.explode(F.sequence(F.lit(0), size - 1)))
    spans = starts.withColumn("e", F.explode(F.sequence(F.col("s") + 1, F.least(F.col("s") + longest, "size"))))
    # A unit has at least its row of whole length in the lattice, so that none is lost; other misses go at once.
    cut = spans.withColumn("piece", F.substring(F.col("unit"), F.col("s") + 1, F.col("e") - F.col("s")))
    edge = F.when(F.col("id").isNotNull(), F.struct((-F.col("score")).alias("rank"), "s", "e", "id"))
    return (cut.join(F.broadcast(pieces), "piece", "left")
            .where(F.col("id").isNotNull() | (F.col("e") - F.col("s") == F.col("size")))
            .groupBy("unit").agg(F.first("size").alias("size"), F.first("n").alias("n"),
                                 F.sort_array(F.collect_list(edge)).alias("edges")))


def merge_fold(size: Column, edges: Column) -> Column:
    """Borders (ascending) after all merges: the best edge over exactly two parts, again and again."""
    longer = F.filter(edges, lambda x: x["e"] - x["s"] > 1)
    one = F.lit(1).cast("bigint")

    def left(n: Column) -> Column:
        return F.call_function("shiftleft", one, n)

    def masked(candidates: Column) -> Column:
        """The borders are the bits of one long integer; an edge is its two ends and the places between them."""
        pairs = F.transform(candidates, lambda x: F.struct(
            left(x["s"]).bitwiseOR(left(x["e"])).alias("ends"), (left(x["e"]) - left(x["s"] + 1)).alias("inner")))

        def walk(pairs: Column) -> Column:
            def best(now: Column) -> Column:
                """The inside of the first edge over two parts, or 0; behind it nothing is tested."""
                return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda found, x: F.when(found != 0, found).when(
                    (now.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(now.bitwiseAND(x["inner"])) == 1),
                    x["inner"]).otherwise(found))

            def step(now: Column, _: Column) -> Column:
                # The sign bit says that no edge was left.
                return F.when(now < 0, now).otherwise(let(best(now), lambda inner: F.when(
                    inner == 0, now.bitwiseOR(F.lit(-1 << 63))).otherwise(now.bitwiseAND(F.bitwise_not(inner)))))
            return F.aggregate(F.sequence(F.lit(1), size - 1), left(size + 1) - 1, step)

        return let(let(pairs, walk), lambda last: F.filter(
            F.sequence(F.lit(0), size), lambda i: last.bitwiseAND(left(i)) != 0))

    def listed(candidates: Column) -> Column:
        def step(now: Column, _: Column) -> Column:
            fits = F.filter(candidates, lambda x: F.array_contains(now, x["s"]) & F.array_contains(now, x["e"]) & (
                F.size(F.filter(now, lambda b: (b > x["s"]) & (b < x["e"]))) == 1))
            return F.transform(F.array(F.get(fits, F.lit(0))), lambda x: F.when(x.isNull(), now).otherwise(
                F.filter(now, lambda b: (b <= x["s"]) | (b >= x["e"]))))[0]
        return F.aggregate(F.sequence(F.lit(1), size - 1), F.sequence(F.lit(0), size), step)

    found = let(longer, lambda c: F.when(size <= MASK_CHARS, masked(c)).otherwise(listed(c)))
    return F.when((size < 2) | (F.size(longer) == 0), F.sequence(F.lit(0), size)).otherwise(found)


def viterbi_fold(size: Column, edges: Column, missing: float = -1e6) -> Column:
    """Borders of the path of the highest score; a sign without a piece costs `missing`."""
    def step(best: Column, e: Column) -> Column:
        """`best` holds (score, borders) of the best path to each place so far."""
        one = F.struct((F.get(best, e - 1)["score"] + missing).alias("score"), (e - 1).alias("s"))
        into = F.transform(F.filter(edges, lambda x: x["e"] == e), lambda x: F.struct(
            (F.get(best, x["s"])["score"] - x["rank"].cast("double")).alias("score"), x["s"].alias("s")))
        top = F.array_max(F.concat(F.array(one), into))
        return F.concat(best, F.transform(F.array(top), lambda t: F.struct(
            t["score"].alias("score"), F.concat(F.get(best, t["s"])["borders"], F.array(e)).alias("borders"))))
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.array(F.lit(0)).alias("borders")))
    return F.aggregate(F.sequence(F.lit(1), size), first, step, lambda best: F.get(best, size)["borders"])


def unit_ids(units: DataFrame, model: Model, fold: str = "merge") -> DataFrame:
    """`unit, n, ids` of distinct units."""
    pieces = units.sparkSession.createDataFrame(model.pieces, "piece string, id int, score double")
    by = merge_fold if fold == "merge" else viterbi_fold
    byte_ids = F.array(*map(F.lit, model.bytes))

    def of(a: Column, b: Column) -> Column:
        """Ids between two borders: the edge there, or the bytes of the one sign there."""
        edge = F.get(F.filter("edges", lambda x: (x["s"] == a) & (x["e"] == b)), F.lit(0))["id"]
        sign = F.hex(F.encode(F.substring(F.col("unit"), a + 1, F.lit(1)), "UTF-8"))
        raw = F.transform(F.sequence(F.lit(1), F.length(sign) - 1, F.lit(2)), lambda i: F.get(
            byte_ids, F.conv(F.substring(sign, i, F.lit(2)), 16, 10).cast("int")))
        return let(edge, lambda found: F.when(found.isNotNull(), F.array(found)).otherwise(raw))

    def between(borders: Column) -> Column:
        return F.flatten(F.transform(F.slice(borders, 2, F.size(borders) - 1), lambda b, i: let(
            F.get(borders, i), lambda a: of(a, b))))

    ids = let(by(F.col("size"), F.col("edges")), between)
    return lattice(units, pieces, model.longest).select("unit", "n", ids.alias("ids"))


def _packed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted unit hashes, where their ids begin, and the ids, for a bounded table."""
    ids = table.column("ids").combine_chunks()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(u.as_py()) for u in table.column("unit")), np.uint64, len(table))
    order = np.argsort(hashes)
    ids = ids.take(pa.array(order))
    return hashes[order], ids.offsets.to_numpy(), ids.flatten().to_numpy().astype(np.uint32)


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, fold: str = "merge",
           sent_units: int = SENT_UNITS) -> DataFrame:
    """For every row: the columns `keep`, and its ids."""
    spark = docs.sparkSession
    keep = ["doc_id"] if keep is None else keep
    table = materialize(unit_ids(distinct_units(docs, path, text), Model(path), fold), "units")
    few = table.limit(sent_units + 1).count() <= sent_units
    rows = docs.select(*keep, F.col(text).alias("_text"))
    if few:
        sent = spark.sparkContext.broadcast(_packed(table.select("unit", "ids").toArrow()))
        hot = spark.sparkContext.broadcast([r["unit"] for r in most_frequent(table, "n", HOT_UNITS).select("unit").collect()])
    else:
        # Texts with the same hash share a set of units; a unit too many does no harm.
        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            m = _model(path)
            for batch in batches:
                key, unit = [], []
                for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = set(m.units(m.normal(t.as_py() or "")))
                    key += [k] * len(found)
                    unit += found
                yield {"_text_key": key, "unit": unit}
        rows = rows.withColumn("_text_key", F.xxhash64("_text"))
        held = (in_batches(rows.select("_text_key", "_text"), own, "_text_key long, unit string").distinct()
                .join(table, "unit").groupBy("_text_key").agg(F.collect_list(F.struct("unit", "ids")).alias("_units")))
        rows = rows.join(held, "_text_key", "left").drop("_text_key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        m, known = _model(path), {}

        def look_up(units: set[str]) -> None:
            hashes, starts, ids = sent.value
            missing = [u for u in units if u not in known]
            at = np.searchsorted(hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, missing), np.uint64, len(missing)))
            known.update((u, ids[starts[i]:starts[i + 1]].tobytes()) for u, i in zip(missing, at))
        if few:
            look_up(set(hot.value))
        for batch in batches:
            out = []
            own = None if few else batch.column("_units")
            for r, t in enumerate(batch.column("_text")):
                units = m.units(m.normal(t.as_py() or ""))
                if few:
                    look_up(set(units))
                    out.append(b"".join(map(known.__getitem__, units)))
                else:
                    mine = {x["unit"]: np.array(x["ids"], np.uint32).tobytes() for x in own[r].as_py() or ()}
                    out.append(b"".join(map(mine.__getitem__, units)))
            ends = np.cumsum([0, *(len(x) // 4 for x in out)]).astype(np.int32)
            flat = np.frombuffer(b"".join(out), np.int32)
            yield {**{c: batch.column(c) for c in keep}, "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}
            if len(known) > HOT_UNITS + FLUSH:
                known.clear()
                look_up(set(hot.value))

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return in_batches(rows, work, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """`encoded` with the text of its ids. Null ids give a null text."""
    names = encoded.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        m = _model(path)
        parts = [bytes([m.byte_of[i]]) if i in m.byte_of else p.replace(MARK, " ").encode() for i, p in enumerate(m.text)]
        for batch in batches:
            texts = []
            for x in batch.column(ids):
                if x.as_py() is None:
                    texts.append(None)
                    continue
                s = b"".join(map(parts.__getitem__, x.values.to_numpy())).decode("utf-8", "replace")
                texts.append(s[1:] if m.prefix and s.startswith(" ") else s)
            yield {**{c: batch.column(c) for c in names}, out: texts}

    return in_batches(encoded, work, T.StructType([*encoded.schema, T.StructField(out, T.StringType())]))
