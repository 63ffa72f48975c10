"""Session settings the feature jobs are tuned for."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable

from pyspark.sql import SparkSession

# Settings that matter for these plans at any scale.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Feature projections widen a row about eightfold, so tasks of under Spark's 1 MB are worth their start
    # where cores would idle; large shuffles go by the advisory size as ever.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key of the spine joins even where the pairing on the same keys then
    # needs one more exchange; its partial aggregate has collapsed the key by that time.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a wide
    # projection fused into one generated method would then run interpreted.
    # Above this size Spark splits the stage out of whole-stage codegen instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyframe",
                  checkpoint_dir: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and benchmarks.

    ``spark.checkpoint.dir`` is left alone when already configured (a cluster
    names its shared folder there); only when unset does a local run get a
    fresh temporary folder.
    """
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TALLYFRAME_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_method_limit(spark: SparkSession) -> None:
    """Set the shipped ``hugeMethodLimit`` where the session still has Spark's default: generated methods above it would run interpreted."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":
        spark.conf.set(key, RECOMMENDED_CONF[key])


def ensure_plain_figures(spark: SparkSession, columns: Iterable[str]) -> None:
    """Have Parquet files of this session hold ``columns`` as plain values, without trying a dictionary first.

    Amounts and ratios hardly repeat, yet Parquet would look each value up in a dictionary a column and row group, which for
    hundreds of columns takes longer than the rest of the write.  Other columns keep theirs; a session that sets
    ``parquet.enable.dictionary``, for all columns or for one, keeps its choice.
    """
    key, chosen = "parquet.enable.dictionary", spark.conf.getAll
    if key in chosen:
        return
    for c in columns:
        if f"{key}#{c}" not in chosen:
            spark.conf.set(f"{key}#{c}", "false")


def ensure_small_files(spark: SparkSession) -> None:
    """Have this session compress Parquet by the shipped codec, which makes files of amounts and ratios a tenth smaller than Spark's; a session's own choice stays."""
    key = "spark.sql.parquet.compression.codec"
    if key not in spark.conf.getAll:
        spark.conf.set(key, RECOMMENDED_CONF[key])


#: State on the executors' disks, with one bound of native memory an executor for all state stores it has.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def ensure_disk_state(spark: SparkSession) -> None:
    """Have streams that begin in this session keep their state in RocksDB: Spark's default holds every row of it in the executors' heap.

    A session that names a provider keeps its choice, and a stream that goes on from a checkpoint the provider that it began with.
    """
    if "spark.sql.streaming.stateStore.providerClass" not in spark.conf.getAll:
        for key, value in DISK_STATE.items():
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession, path: str | None = None) -> str:
    """Return the session's checkpoint folder, setting one only where none is configured.

    On a cluster the folder must come from ``spark.checkpoint.dir``; only local
    sessions (tests, benchmarks) get a temporary folder of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        return current
    if path is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: a cluster job needs a shared folder "
                         "(HDFS/S3/ABFS) there; a machine-local folder would be lost with its executor")
    path = path or tempfile.mkdtemp(prefix="tallyframe-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
