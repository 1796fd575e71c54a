"""Where intermediate tables live, and how small tables reach the executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A derived table of at most this many rows is broadcast; a larger one is joined by shuffle.
SMALL_ROWS = 10_000
SMALL_BYTES = 64_000_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster names in `spark.checkpoint.dir`.

    All paths of an application share one subfolder, which may be deleted once the
    application has ended. Only a local session, where driver and executors share one machine, may fall
    back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="textmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/textmill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", file_rows: int = 0) -> DataFrame:
    """Write `df` once as Parquet and read it back: the lineage is cut, and the table
    survives the loss of an executor.

    Tables of very large rows need `file_rows`, the most rows of a file: Spark's writer counts what it holds
    every hundred rows only, and its reader takes thousands of rows of a file at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like `materialize`, in buckets of `key`: joins on `key` then shuffle the other table only.

    Every task writes its rows to the buckets by itself, so storing shuffles nothing. The table is named in the session's
    catalog, and its files are below the scratch folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def small_table(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Evaluate a derived table once so that later plans do not repeat its work.

    Up to `max_rows` rows of `max_bytes` in all become a local relation with a broadcast hint. A
    table that turns out larger is written out and returned without a hint: Spark then
    shuffles it, and adaptive execution splits skewed partitions.
    """
    local = df.limit(max_rows + 1).toArrow()
    if local.num_rows <= max_rows and local.nbytes <= max_bytes:
        return F.broadcast(df.sparkSession.createDataFrame(local, df.schema))
    return materialize(df, "large")


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of an input that has fewer splits than the cluster has cores.

    Never applies to a large table, which has many more splits than cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
