"""Shared helpers: scratch tables in the shared folder, code shipping, connected components."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.plans.session import ensure_checkpoint_dir

#: ASCII white space that line keys and shingle words are cut at: space and 0x09-0x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, as any job does with ``--py-files``."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    name = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tallyframe-code-")), "tallyframe_code.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(package.rglob("*")):
            if p.suffix in (".py", ".yml"):
                z.write(p, p.relative_to(package.parent))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)


class Scratch:
    """Tables of one operator run under the folder that ``spark.checkpoint.dir`` names.

    ``keep`` writes a table and reads it back, which cuts the lineage: a lost
    executor never repeats what stands before it.  ``drop`` removes a table
    that is no longer read; what is left goes when the session ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        path, fs = self._fs(self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _fs(self, where: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        where = f"{self.root}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = self._fs(f"{self.root}/{name}")
            fs.delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of stages whose results are written: it does when the driver finds them unreachable."""
    gc.collect()
    spark._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_, name__, ... that no column of ``df`` has (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash128(*cols) -> tuple:
    """Two 64-bit hashes of the columns with unrelated seeds."""
    return F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)


def indexed(rows: DataFrame, group: str, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``idx`` (from 0, by ``order`` within ``group``, which is not null) and ``n``, the group's size.

    A range sort deals the rows out, so a group of any size spreads over the partitions; a row's number is its place
    in its sorted partition and the rows of its group in earlier ones.
    """
    placed = (rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
              .withColumn("place", F.monotonically_increasing_id()))
    placed = scratch.keep(name, placed).withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy(group, "part").agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    earlier = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = parts.select(group, "part", (F.col("low") - earlier).alias("shift"), F.sum("rows").over(whole).alias("n"))
    return (placed.join(shifts, [group, "part"]).withColumn("idx", F.col("place") - F.col("shift"))
            .drop("place", "part", "shift"))


def connected_components(edges: DataFrame, scratch: Scratch, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the smallest node reachable.

    Alternating star contraction (Kiveris et al., 2014): a large-star round
    links each node's larger neighbours to its smallest one, a small-star round
    its smaller ones, until no edge changes.  The number of edges never grows,
    each round is written to the shared folder, and a hub's edges are met by
    partial aggregation and joins against unique keys, never as one group.
    """
    def normal(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        near = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            near = near.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        joined = near.join(least, "u")
        if large:
            return normal(joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        return normal(linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))

    def mark(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    now = scratch.keep(f"{label}-0", normal(edges))
    before, last = mark(now), None
    for k in range(1, max_rounds + 1):
        if before[0] == 0:
            break
        now = scratch.keep(f"{label}-{k}", star(star(now, True), False))
        after = mark(now)
        scratch.drop(f"{label}-{k - 1}")
        if after == before:
            break
        before, last = after, k
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
