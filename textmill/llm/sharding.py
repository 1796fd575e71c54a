"""Sharding by a minimax contiguous partition of ordered atomic groups.

Rows with equal texts are one atomic group. Groups are ordered by a hash of the text
and cut into contiguous shards so that the largest shard is as small as it can be:
a binary search over the capacity, checked greedily. A group that is larger than an
even share of what is left (a hot text) gets a shard of its own first, and the
others are cut over the shards that remain.

The driver never sees the groups: it sees the sizes of `BINS` contiguous ranges of the
order, and then only the finer ranges of those bins in which a cut can lie, until
these are single groups. A row finds its shard by comparing its hash with the cuts.

Null texts count as empty (size 1). Repeated rows are rows of one group. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import numbered
from textmill.runtime import materialize

SHARDS = 16
# Bits of the order that one look at the table tells apart.
LEVEL_BITS = 12
KEY_BITS = 60


def order_key(text: Column) -> Column:
    """60 bits of a digest: equal texts are equal, and their order does not follow their length or content."""
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def greedy(sizes: list[int], capacity: int) -> list[int]:
    """Where shards begin if each takes as many parts as it can; no part is larger than the capacity."""
    starts, held = [], None
    for i, s in enumerate(sizes):
        if held is None or held + s > capacity:
            starts.append(i)
            held = 0
        held += s
    return starts


def smallest_capacity(sizes: list[int], shards: int, low: int) -> int:
    """The smallest capacity not below `low` with which `greedy` needs at most `shards` shards."""
    low = max([low, *sizes, -(-sum(sizes) // shards)])
    high = max(low, sum(sizes))
    while low < high:
        mid = (low + high) // 2
        if len(greedy(sizes, mid)) <= shards:
            high = mid
        else:
            low = mid + 1
    return low


def _ranges(groups: DataFrame, parts: list[tuple[int, int]], bits: int) -> list[tuple[int, int, int, int]]:
    """(first key, width in bits, bytes, groups) of the non-empty ranges of `bits` more bits inside `parts`."""
    out = []
    for width in sorted({w for _, w in parts}):
        fine = max(0, width - bits)
        starts = [k for k, w in parts if w == width]
        inside = groups.where(F.shiftright("_key", width).isin([k >> width for k in starts]))
        out += [(r["p"] << fine, fine, r["s"], r["g"]) for r in
                inside.groupBy(F.shiftright("_key", fine).alias("p"))
                .agg(F.sum("_bytes").alias("s"), F.count(F.lit(1)).alias("g")).collect()]
    return out


def cut_points(groups: DataFrame, shards: int) -> list[int]:
    """The first keys of the shards of a stored table of groups (`_key`, `_bytes`), in order.

    Bins that hold several groups bound the capacity from both sides: cut only between bins, it is
    too high; with bins as if they could be divided at will, too low. Bins in which
    a cut can lie under any capacity in between are split further.
    """
    parts = _ranges(groups, [(0, KEY_BITS)], LEVEL_BITS)
    while parts:
        parts.sort()
        sizes = [s for _, _, s, _ in parts]
        high = smallest_capacity(sizes, shards, 0)
        single = max((s for _, _, s, g in parts if g == 1), default=0)
        low = max(single, -(-sum(sizes) // shards))
        unsure = {i for i in _touched(sizes, low, high, shards) if parts[i][3] > 1 and parts[i][1] > 0}
        if not unsure:
            return [parts[i][0] for i in greedy(sizes, high)]
        parts = [p for i, p in enumerate(parts) if i not in unsure] + _ranges(
            groups, [parts[i][:2] for i in unsure], LEVEL_BITS)
    return []


def _touched(sizes: list[int], low: int, high: int, shards: int) -> set[int]:
    """Bins in which a cut of an optimal partition can lie.

    Shard j ends at the latest where j+1 full shards of `high` end, and at the earliest where the rest
    can still be held by the other shards; all bins between these places are touched.
    """
    from bisect import bisect_left
    from itertools import accumulate
    ends, total = list(accumulate(sizes)), sum(sizes)
    out: set[int] = set()
    for j in range(1, shards):
        first, last = max(0, total - (shards - j) * high), min(total, j * high)
        a, b = bisect_left(ends, first), bisect_left(ends, last)
        out.update(range(a, min(b, len(sizes) - 1) + 1))
    return out


def shard_by_bytes(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                   shards: int = SHARDS) -> DataFrame:
    """For every row: the columns `keep`, size, text_crc32, law, shard, slot, grown_shard."""
    keep = ["doc_id"] if keep is None else keep
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(docs.select(
        *keep, (F.octet_length(whole) + 1).cast("bigint").alias("size"), F.crc32(whole).alias("text_crc32"),
        order_key(whole).alias("_key")), "sized")
    groups = materialize(rows.groupBy("_key").agg(F.sum("size").alias("_bytes")), "groups")

    # Hot groups first: while the largest group exceeds an even share of the rest, it fills a shard alone.
    left, total, hot = shards, groups.agg(F.sum("_bytes")).first()[0] or 0, []
    for r in groups.orderBy(F.desc("_bytes"), "_key").limit(shards - 1).collect():
        if left == 1 or r["_bytes"] * left < total:
            break
        hot.append(r["_key"])
        left, total = left - 1, total - r["_bytes"]
    rest = groups.where(~F.col("_key").isin(hot)) if hot else groups
    cuts = cut_points(rest, left)

    shard = F.lit(len(hot))
    for c in cuts[1:]:
        shard = shard + (F.col("_key") >= c).cast("int")
    for i, k in enumerate(hot):
        shard = F.when(F.col("_key") == k, F.lit(i)).otherwise(shard)
    put = rows.withColumn("shard", shard.cast("int"))
    return numbered(put, "shard", [*keep, "_key"], [*keep, "_key"], "slot").select(
        *keep, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
