"""Reproducible stratified train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.operators.corpus import KEY
from textmill.operators.ranking import hash_key
from textmill.runtime import materialize, small_table


def test_shares(counts: DataFrame, test_size: float = 0.2) -> DataFrame:
    """(label, n, n_test): ceil(test_size * N) test rows dealt to the classes in proportion,
    the last ones by largest remainder (ties in label order)."""
    every = W.partitionBy()
    wide = counts.select(
        "label", "n",
        F.sum("n").over(every).cast("decimal(18,0)").alias("total"))
    # Exact integers: counts times totals may pass 64 bits.
    n_test = F.ceil(F.lit(test_size) * F.col("total").cast("double")).cast("decimal(18,0)")
    share = F.col("n").cast("decimal(18,0)") * n_test
    parts = wide.withColumn("rest", share % F.col("total")).withColumn(
        "base", ((share - F.col("rest")) / F.col("total")).cast("long"))
    left = n_test.cast("long") - F.sum("base").over(every)
    place = F.row_number().over(W.orderBy(F.desc("rest"), F.asc("label")))
    dealt = parts.withColumn("left", left).withColumn("place", place)
    return dealt.select(
        "label", "n", (F.col("base") + (F.col("place") <= F.col("left")).cast("long")).alias("n_test"))


def stratified_split(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, key: list[str] = KEY
) -> DataFrame:
    """Add `split` ('train' or 'test'), per label in proportion.

    Rows are ordered by a hash of key and seed, and each label's first `n_test` rows form
    the test set. Instead of ranking all rows, the job counts rows per (label, hash
    prefix), ranks only the one prefix per label in which the cut falls, and then
    compares every row with its label's cut. The table itself is never shuffled.
    """
    digest = hash_key(key, seed)
    order = F.struct("_h", *key)
    hashed = df.select(*key, "label", digest.alias("_h"))
    bucket = F.substring("_h", 1, 4)
    sizes = materialize(hashed.groupBy("label", bucket.alias("_b")).agg(F.count("*").alias("_n")), "sizes")
    totals = sizes.groupBy("label").agg(F.sum("_n").alias("n"))
    upto = W.partitionBy("label").orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = sizes.withColumn("_upto", F.sum("_n").over(upto))
    holds_cut = (F.col("n_test") > F.col("_upto") - F.col("_n")) & (F.col("n_test") <= F.col("_upto"))
    shares = test_shares(totals, test_size)
    cuts = small_table(
        shares.join(
            running.join(shares, "label").filter(holds_cut)
            .select("label", "_b", (F.col("n_test") - F.col("_upto") + F.col("_n")).alias("_need")),
            "label", "left"))
    if not cuts.filter(F.col("n") < 2).isEmpty():
        raise ValueError("every label needs at least two rows")
    near = hashed.withColumn("_b", bucket).join(cuts.select("label", "_b", "_need"), ["label", "_b"])
    rank = F.row_number().over(W.partitionBy("label").orderBy("_h", *key))
    last = small_table(
        near.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_need"))
        .select("label", order.alias("_cut")))
    split = F.when(order <= F.col("_cut"), "test").otherwise("train")
    return (
        df.withColumn("_h", digest).join(last, "label", "left")
        .withColumn("split", split).select(*df.columns, "split")
    )
