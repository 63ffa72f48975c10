"""Sinks: overwrite a feature table, or stage an intermediate panel once."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_features(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: list[str] | None = None, bucket_by: list[str] | None = None,
                   num_buckets: int = 0) -> None:
    """Write to a path (contains ``/``) or a managed table ``db.table``.

    For a table the database is created first when missing.  ``bucket_by`` (tables
    only) hash-buckets and sorts the files by those keys, so later joins of the
    table on them (e.g. back to a spine) read co-partitioned data without a
    shuffle.  The write is the job's only action; task retries and speculative
    attempts are safe because the file committer only publishes files of the
    successful attempt.  A bucket is written by as many tasks as its size takes, a file each,
    so few buckets don't make large tasks.
    """
    if bucket_by and "/" in target:
        raise ValueError("bucketing needs a table target")
    n = num_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if bucket_by:
        # Partitions are a multiple of the buckets, so each is part of one bucket; AQE puts small ones together and splits a hot key's.
        several = -(-int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n)
        df = df.hint("rebalance", n * several, *[F.col(c) for c in bucket_by])
    elif partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])  # AQE splits a large partition value
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(n, bucket_by[0], *bucket_by[1:]).sortBy(bucket_by[0], *bucket_by[1:])
    if "/" in target:
        writer.save(target)
        return
    if "." in target:
        space = ".".join(f"`{part}`" for part in target.split(".")[:-1])  # database, or catalog and database
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {space}")
    writer.saveAsTable(target)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir`` (must be set)."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("spark.checkpoint.dir is not set; stage_panel needs a shared folder")
    return path.rstrip("/")


def owned_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared one that is removed when the session's JVM ends."""
    where = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return where


def stage_panel(df: DataFrame, path: str | None = None, columns: list[str] | None = None,
                bucket_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet once and read it back (optionally only ``columns``).

    Cuts the lineage: later jobs start from the written files, so a lost
    executor never recomputes the upstream joins.  Without ``path`` the files
    go to a fresh folder under the shared checkpoint directory, which goes with the session.

    With ``bucket_by`` the files are bucketed by these keys into as many buckets as a shuffle has partitions: an
    aggregate on the keys is written as it is dealt out, and a later join on them doesn't move the staged rows.

    The shuffle files of what made the rows are not read again and go when the files are written.
    """
    spark = df.sparkSession
    path = path or owned_dir(spark, "staged")
    if bucket_by:
        staged = _stage_buckets(df, path, bucket_by)
    else:
        df.write.mode("overwrite").parquet(path)
        staged = spark.read.parquet(path)
    _release(spark)
    return staged.select(*columns) if columns else staged


def _release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of written stages: it does when the driver's collector finds them unreachable."""
    gc.collect()
    spark._jvm.System.gc()


#: Buckets that a task writes side by side; a task with more sorts the rows of the others.
OPEN_BUCKETS = 4


@contextmanager
def _unsorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Writes in here keep a file open for each bucket of a task: Spark would sort all rows by bucket first, which for wide ones spills."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    if int(before) < OPEN_BUCKETS:
        spark.conf.set(key, str(OPEN_BUCKETS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _stage_buckets(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """The rows as files in buckets.  Only a table's files can have any, so the catalogue names them while the frame is made."""
    spark = df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _unsorted_buckets(spark):
        df.write.format("parquet").option("path", f"{path}/rows").bucketBy(buckets, *keys).saveAsTable(name)
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return staged
