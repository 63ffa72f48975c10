"""Incremental feature stream: files arriving in two rounds give the batch job's answer."""

import datetime as dt
import os

from tallyframe.catalog import Catalog
from tallyframe.sources.schema import ACCOUNT_CODES, FLAG
from tallyframe.streaming.features_stream import batch_features, start_feature_stream


def test_stream_matches_batch(spark, scratch_dir):
    cat = Catalog.default()
    schema = ("party_id long, data_date date, prev_financial_indicator int, "
              + ", ".join(f"`{c}` double" for c in ACCOUNT_CODES))

    def filing(p, flag, base):
        return (p, dt.date(2019, 12, 31), flag, *[base + i for i in range(len(ACCOUNT_CODES))])

    src = os.path.join(scratch_dir, "in")
    sink = os.path.join(scratch_dir, "out")
    first = spark.createDataFrame([filing(1, 0, 10.0), filing(1, 1, 5.0)], schema)
    second = spark.createDataFrame([filing(2, 0, 20.0)], schema)
    first.write.parquet(os.path.join(src, "a"))
    q = start_feature_stream(spark, os.path.join(src, "*"), first.schema, sink,
                             checkpoint=os.path.join(scratch_dir, "ck"))
    q.awaitTermination()
    second.write.parquet(os.path.join(src, "b"))
    q = start_feature_stream(spark, os.path.join(src, "*"), first.schema, sink,
                             checkpoint=os.path.join(scratch_dir, "ck"))
    q.awaitTermination()
    got = spark.read.parquet(sink).drop("batch_id")
    expected = batch_features(first.unionByName(second), cat)
    assert got.count() == 2
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert FLAG not in got.columns
