"""Exact ranks and top rows per group that never sort a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hash_key(columns: list[str], seed: int | None = None) -> Column:
    """Hex digest of the key columns: a reproducible shuffle order."""
    parts = [F.col(c).cast("string") for c in columns]
    return F.md5(F.concat_ws("|", *parts, *([] if seed is None else [F.lit(str(seed))])))


def rank_within(
    df: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str = "rank"
) -> DataFrame:
    """Dense 1-based position of each row in its group.

    `bucket` must not decrease along `order`. Rows are ranked inside (group, bucket), and
    the sizes of the earlier buckets are added; a hot group is thus spread over as many
    tasks as it has buckets.
    """
    keyed = df.withColumn("_bucket", bucket)
    parts = [*group, "_bucket"]
    before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*parts).agg(F.count("*").alias("_n"))
        .select(*parts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    local = F.row_number().over(W.partitionBy(*parts).orderBy(*order))
    return (
        keyed.withColumn("_local", local)
        .join(offsets, parts)
        .withColumn(name, F.col("_base") + F.col("_local"))
        .drop("_bucket", "_local", "_base")
    )


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first `n` rows of each group.

    The first round keeps `n` rows of every (group, salt), so the second one never
    sees more than `n` rows per salt, however hot the group.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(64))
    first = F.row_number().over(W.partitionBy(*group, "_salt").orderBy(*order))
    final = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return (
        df.withColumn("_salt", salt)
        .withColumn("_rn", first).filter(F.col("_rn") <= n)
        .withColumn("_rn", final).filter(F.col("_rn") <= n)
        .drop("_salt", "_rn")
    )
