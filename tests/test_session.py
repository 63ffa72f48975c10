"""Checkpoint-folder rules: use the configured shared folder; never invent a local one on a cluster."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tallyframe.plans.session import ensure_checkpoint_dir, ensure_method_limit, ensure_plain_figures
from tests.conftest import SF_SMALL


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf, ckpt=None):
        self.master, self._conf, self._ckpt = master, _Conf(conf), ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(_Context("yarn", {})))


def test_configured_folder_is_kept():
    sc = _Context("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert ensure_checkpoint_dir(_Session(sc)) == "hdfs://nn/ckpt"
    assert sc.getCheckpointDir() is None     # nothing was overwritten


def test_local_session_gets_a_scratch_folder():
    sc = _Context("local[4]", {})
    path = ensure_checkpoint_dir(_Session(sc))
    assert path and sc.getCheckpointDir() == path


def test_method_limit_is_set_unless_chosen(spark, own_settings):
    key = "spark.sql.codegen.hugeMethodLimit"
    for before, after in (("65535", "8000"), ("20000", "20000")):
        own_settings(key, before)
        ensure_method_limit(spark)
        assert spark.conf.get(key) == after


def test_figures_are_written_without_dictionaries(spark, scratch_dir):
    """Feature columns are plain, others keep theirs; a session's own choice stays."""
    from __spark_entry__ import queries

    def encodings(session, where):
        session.range(500).selectExpr("'a' AS name", "1.5D AS LQ_01", "2.5D AS LQ_02").coalesce(1).write.parquet(where)
        (part,) = Path(where).glob("*.parquet")
        group = pq.ParquetFile(part).metadata.row_group(0)
        return {group.column(i).path_in_schema: any("DICTIONARY" in e for e in group.column(i).encodings) for i in range(3)}

    registered = spark.newSession()
    queries()["filter_month"](registered, SF_SMALL)
    assert encodings(registered, f"{scratch_dir}/registered") == {"name": True, "LQ_01": False, "LQ_02": False}
    one, every = spark.newSession(), spark.newSession()
    one.conf.set("parquet.enable.dictionary#LQ_02", "true")
    every.conf.set("parquet.enable.dictionary", "true")
    for session in (one, every):
        ensure_plain_figures(session, ["LQ_01", "LQ_02"])
    assert encodings(one, f"{scratch_dir}/one") == {"name": True, "LQ_01": False, "LQ_02": True}
    assert encodings(every, f"{scratch_dir}/every") == {"name": True, "LQ_01": True, "LQ_02": True}


def test_files_take_the_shipped_codec_unless_chosen(spark, scratch_dir):
    from __spark_entry__ import queries

    key = "spark.sql.parquet.compression.codec"
    for name, chosen, want in (("own", None, "ZSTD"), ("chosen", "snappy", "SNAPPY")):
        session = spark.newSession()
        session.conf.set(key, chosen) if chosen else session.conf.unset(key)
        queries()["filter_month"](session, SF_SMALL)
        session.range(10).coalesce(1).write.parquet(f"{scratch_dir}/{name}")
        (part,) = Path(f"{scratch_dir}/{name}").glob("*.parquet")
        assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == want
