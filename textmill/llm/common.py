"""Parts that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textmill.runtime import materialize

# ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
# Words of a shingle or of a repeated window.
SHINGLE = 5
# Texts and bytes in an Arrow batch: long texts must not pile up in a Python worker.
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20
# Rows of a derived table that is small enough to be sent to every executor.
SMALL_ROWS = 100_000


_HELD: dict = {}


def held_by_worker(key: tuple, make: Callable):
    """`make()`, kept by the Python worker for its next tasks. A worker holds one such object: another key frees it."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            # What the earlier stage used goes back to the system, or stages would add up in a worker that is used again.
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)
        _HELD[key] = make()
    return _HELD[key]


def most_frequent(df: DataFrame, count: str, limit: int) -> DataFrame:
    """Rows of the highest counts, at most `limit` of them; rows of nearly equal counts stay or go together.

    The cut comes from a histogram of counts on a logarithmic scale, so nothing is sorted.
    """
    step = F.floor(F.log2(count) * 8)
    left, cut = limit, None
    for r in sorted(df.groupBy(step.alias("step")).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        cut = r["step"]
    return df.where(F.lit(False) if cut is None else step >= cut)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words between ASCII white space; none for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def window_hashes(tokens: Column) -> Column:
    """A 64-bit hash of every five consecutive tokens, in text order."""
    def hashes(w: Column) -> Column:
        def at(i: Column) -> Column:
            return F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE)))
        return F.when(F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), at)
                      ).otherwise(F.array().cast("array<bigint>"))
    return let(tokens, hashes)


def in_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
               schema: str | T.StructType) -> DataFrame:
    """`mapInArrow` for functions that yield columns as a dict of lists or arrays, in small batches."""
    spark = df.sparkSession
    # The setting is read when the plan runs, so it holds for the session from here on.
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    kind = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
                 for f, c in ((f, columns[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, kind)


def checked_small(df: DataFrame, max_rows: int = SMALL_ROWS, name: str = "lookup") -> DataFrame:
    """Store a narrow derived table; it gets a broadcast hint only if it has at most `max_rows` rows.

    Without the hint Spark joins it by shuffle, and adaptive execution splits skewed keys.
    """
    stored = materialize(df, name)
    return F.broadcast(stored) if stored.limit(max_rows + 1).count() <= max_rows else stored


def numbered(df: DataFrame, group: str, spread: list[str], order: list[str], out: str,
             bucket_rows: int = 5_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, without putting a group into one task.

    The rows of a group go to hash buckets of `spread` columns of about `bucket_rows`
    rows; a bucket is numbered by a window and then shifted by the rows of the
    group's earlier buckets. `df` is evaluated twice and should be stored.
    """
    from pyspark.sql import Window

    # A power of two that follows the table's size, so that buckets stay small at every scale.
    n = 1
    total = df.count()
    while n * bucket_rows < total:
        n *= 2
    put = df.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(n)))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (put.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    starts = checked_small(starts, name="starts").withColumnsRenamed({group: "_group", "_bucket": "_in"})
    local = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (put.withColumn("_row", F.row_number().over(local) - 1)
            .join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_in")))
            .withColumn(out, (F.col("_start") + F.col("_row")).cast("bigint"))
            .drop("_bucket", "_in", "_start", "_row", "_group"))
