"""Published tables, the keyed store, staged panels, the clustered layout and the spine's runtime filter."""

import datetime as dt
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import runtime_filter as rf
from tallyframe.operators.spine import restrict_to_spine
from tallyframe.sources import layout, published, staging
from tallyframe.sources.keyed_store import KeyedStore, add_to_ranges
from tallyframe.sources.published import Conflict, Published, publish_table
from tallyframe.sources.readers import scan_statements_window


def executed(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def metric(df, node, name):
    """Sum of a metric over the operators of a name, from one run of the frame."""
    df = df.select("*")  # counters of its own
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()

    def walk(p):
        here = p.metrics().get(name).get().value() if p.nodeName().startswith(node) and p.metrics().contains(name) else 0
        inner = [p.executedPlan()] if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else []
        inner += [p.plan()] if p.getClass().getSimpleName().endswith("QueryStageExec") else []
        kids = p.children()
        return here + sum(walk(c) for c in [*inner, *(kids.apply(i) for i in range(kids.size()))])

    return walk(plan)


# Runtime filter

def test_spine_filter_keeps_every_key_and_few_others(spark):
    rows = spark.range(40_000).select((F.col("id") % 5000).alias("party_id"),
                                      F.expr("make_date(2010 + CAST(id div 5000 AS INT), 12, 31)").alias("data_date"), F.col("id").alias("v"))
    spine = rows.where("party_id % 20 = 3").select("party_id", "data_date")
    passed = rf.prefilter(rows, spine)
    got = {r["v"] for r in passed.collect()}
    want = {r["v"] for r in rows.join(spine, ["party_id", "data_date"], "left_semi").collect()}
    assert want <= got and len(want) == 2000 and len(got) < 2000 + 0.03 * 38_000
    assert {r["v"] for r in restrict_to_spine(rows, spine, runtime_filter=True).collect()} == want


def test_spine_filter_stands_under_the_exchange(spark, scratch_dir):
    path = os.path.join(scratch_dir, "st")
    (spark.range(20_000).select((F.col("id") % 1000).alias("party_id"), F.expr("make_date(2000 + CAST(id div 1000 AS INT), 12, 31)").alias("data_date"),
                                F.rand(1).alias("A_1")).write.parquet(path))
    rows = spark.read.parquet(path)
    rows.where("party_id % 25 = 0").select("party_id", "data_date").write.parquet(path + "-spine")
    spine = spark.read.parquet(path + "-spine")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, filtered = restrict_to_spine(rows, spine), restrict_to_spine(rows, spine, runtime_filter=True)
        plan = executed(filtered)
        lines = plan.splitlines()
        tested = next(k for k, line in enumerate(lines) if "Filter" in line and "Subquery subquery" in line)
        above = [line.split("Exchange")[0] for line in lines[:tested] if "Exchange hashpartitioning(party_id" in line]
        assert len(above) == 1 and "FileScan parquet [party_id" in plan and "Exchange" in lines[tested - 1] + lines[tested - 2]
        before = metric(plain, "Exchange", "shuffleRecordsWritten")
        after = metric(filtered, "Exchange", "shuffleRecordsWritten")
        # 800 rows of the spine; of the statements 800 and about one in a hundred of the rest instead of 20,000.
        assert before == 20_800 and after < 800 + 800 + 0.03 * 19_200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, filtered.collect())) == sorted(map(tuple, plain.collect()))


def test_spine_filter_sizes(spark):
    assert rf.words_needed(0) == 1 and rf.words_needed(4) == 1 and rf.words_needed(5) == 2 and rf.words_needed(1000) == 256
    spine = spark.range(3000).select((F.col("id") % 100).alias("party_id"), F.expr("date_add(DATE'2020-01-01', CAST(id AS INT))").alias("data_date"))
    assert rf.filter_keys(spine) == (("party_id", "data_date"), 1024) or rf.filter_keys(spine)[0] == ("party_id", "data_date")
    assert rf.filter_keys(spine, max_bytes=512)[0] == ("party_id",)  # the whole key would not fit
    assert rf.filter_keys(spine, max_bytes=64) == ((), 0)
    rows = spine.withColumn("v", F.lit(1))
    assert rf.prefilter(rows, spine, max_bytes=64) is rows
    some = spine.where("party_id < 10")
    assert rf.prefilter(rows, some, max_bytes=64, expected_keys=10).where("party_id < 10").count() == 300
    words = rf.filter_words(some, ("party_id",), 8).first()["words"]
    assert len(words) == 8 and any(words)


def test_spine_filter_nulls_and_empty_spine(spark):
    rows = spark.createDataFrame([(1, dt.date(2020, 12, 31), "a"), (None, dt.date(2020, 12, 31), "b"), (2, None, "c")],
                                 "party_id long, data_date date, v string")
    spine = spark.createDataFrame([(1, dt.date(2020, 12, 31)), (None, dt.date(2020, 12, 31)), (2, None)], "party_id long, data_date date")
    assert [r["v"] for r in rf.prefilter(rows, spine).collect()] == ["a"]
    assert rf.prefilter(rows, spine.limit(0)).count() == 0
    named = spine.select(F.col("party_id").alias("p"), F.col("data_date").alias("d"))
    assert [r["v"] for r in restrict_to_spine(rows, named, spine_keys=["p", "d"], runtime_filter=True).collect()] == ["a"]


# Published tables

def test_publish_replaces_atomically(spark, scratch_dir):
    table = Published(spark, os.path.join(scratch_dir, "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.write(spark.range(10)) == 1
    old = table.read()
    broken = spark.range(10, 1000, 1, 8).select(F.when(F.col("id") > 900, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        table.write(broken)
    assert table.read().count() == 10 and table.log.latest()[0] == 1  # the old table is there, what was half written is not seen
    assert table.write(table.read().unionByName(spark.range(10, 12))) == 2  # overwritten from itself
    assert table.read().count() == 12 and old.count() == 10 and table.read(version=1).count() == 10
    assert table.write(spark.range(0).withColumn("x", F.lit("y"))) == 3 and table.read().columns == ["id", "x"]


def test_publish_dies_before_the_switch(spark, scratch_dir, monkeypatch):
    table = Published(spark, os.path.join(scratch_dir, "t"))
    table.write(spark.range(5))
    with monkeypatch.context() as m:
        m.setattr(published.VersionLog, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.write(spark.range(50))
    assert table.read().count() == 5 and len(table.log.folder.names("data")) == 2
    table.log.folder.create("_versions/00000000000000000002", "")  # a writer that died between making its file and filling it
    assert table.read().count() == 5
    assert table.write(spark.range(6)) == 3 and table.read().count() == 6
    assert len(table.vacuum(keep=1, grace=-1)) == 2 and table.read().count() == 6 and table.vacuum(grace=-1) == []


def test_publish_conflict(spark, scratch_dir):
    a, b = (published.VersionLog(spark, os.path.join(scratch_dir, "t")) for _ in range(2))
    assert a.commit({"x": 1}, 0) == 1
    with pytest.raises(Conflict):
        b.commit({"x": 2}, 0)
    assert b.commit({"x": 2}, 1) == 2 and a.latest() == (2, {"x": 2})


def test_publish_partitioned(spark, scratch_dir):
    table = Published(spark, os.path.join(scratch_dir, "t"))
    table.write(spark.range(10).select(F.col("id"), (F.col("id") % 3).cast("int").alias("k"), (F.col("id") * 2).alias("v")), fmt="orc", partition_by=["k"])
    assert table.read().columns == ["id", "k", "v"] and table.read().where("k = 1").count() == 3
    assert "PartitionFilters: [isnotnull(k" in executed(table.read().where("k = 1"))


def test_publish_table_in_the_catalogue(spark):
    name = "published_db.features"
    rows = spark.range(100).select(F.col("id").alias("party_id"), F.col("id").cast("double").alias("x"))
    first = publish_table(rows, name, fmt="orc", bucket_by=["party_id"], num_buckets=4)
    with pytest.raises(Exception, match="killed"):
        publish_table(rows.select("party_id", F.when(F.col("party_id") == 99, F.raise_error(F.lit("killed"))).cast("double").alias("x")), name)
    assert spark.table(name).count() == 100
    second = publish_table(spark.table(name).where("party_id < 60"), name, fmt="orc", bucket_by=["party_id"], num_buckets=4)
    assert spark.table(name).count() == 60 and first < second and spark.table(first).count() == 100
    plan = executed(spark.table(name).join(spark.table(name).withColumnRenamed("x", "y").hint("merge"), "party_id"))
    assert "Exchange" not in plan  # the view hands the buckets through
    third = publish_table(spark.table(name).where("party_id < 5"), name, keep=1)
    left = {r["tableName"] for r in spark.sql("SHOW TABLES IN published_db LIKE 'features__g*'").collect()}
    assert spark.table(name).count() == 5 and left == {third.split(".")[1]}
    rows.write.mode("overwrite").saveAsTable("published_db.plain")
    with pytest.raises(ValueError, match="is a table"):
        publish_table(rows, "published_db.plain")


# Keyed store

STORE = "party_id long, data_date date, x double, s string"


def batches(seed, n=6):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        rows = [(rng.randrange(30), dt.date(2020, 12, 31), rng.choice([None, float(rng.randrange(5))]), f"{seq}") for _ in range(40)]
        rows.append((None, dt.date(2020, 12, 31), float(seq), "no party"))
        out.append((seq, rows))
    return out


def newest(done):
    best = {}
    for seq, rows in done:
        for r in rows:
            order = (seq, *[(v is not None, v) if v is not None else (False, 0) for v in r[2:]])
            if r[:2] not in best or best[r[:2]][0] < order:
                best[r[:2]] = (order, r)
    return sorted((r for _, r in best.values()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_store_takes_batches_in_any_order(spark, scratch_dir, seed):
    store = KeyedStore(spark, os.path.join(scratch_dir, "s"), STORE, buckets=3)
    assert store.read().count() == 0
    given = batches(seed)
    random.Random(seed).shuffle(given)
    for k, (seq, rows) in enumerate(given):
        store.upsert(spark.createDataFrame(rows, STORE), seq)
        if k % 3 == seed % 3:
            before = store.read().collect()
            store.compact()
            assert sorted(map(tuple, store.read().collect()), key=str) == sorted(map(tuple, before), key=str)
            assert all(len(f) == 1 for f in store.manifest()[1]["folders"].values())
        if k == 3:  # a replay, with other rows: its number is there
            version = store.log.latest()[0]
            store.upsert(spark.createDataFrame([(1, dt.date(2020, 12, 31), 99.0, "z")], STORE), seq)
            assert store.log.latest()[0] == version
        assert sorted(map(tuple, store.read().collect()), key=str) == newest(given[:k + 1])
    assert store.manifest()[1]["applied"] == [[0, 5]]
    kept = [r["party_id"] for r in store.read().collect()]
    assert len(kept) == len(set(kept))


def test_store_rewrites_touched_buckets_only(spark, scratch_dir):
    store = KeyedStore(spark, os.path.join(scratch_dir, "s"), "k long, v long", keys=["k"], buckets=8)
    store.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v")), 1)
    first = store.manifest()[1]["folders"]
    store.upsert(spark.createDataFrame([(5, 1)], "k long, v long"), 2)
    touched = {b for b, f in store.manifest()[1]["folders"].items() if len(f) > 1}
    assert len(first) == 8 and len(touched) == 1
    plan = executed(store.read())
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2  # only the touched bucket is merged
    store.compact()
    after = store.manifest()[1]["folders"]
    assert {b for b in first if first[b] != after[b]} == touched and "Exchange" not in executed(store.read())
    assert store.read().where("v = 1").collect()[0]["k"] == 5 and store.read().count() == 1000
    assert len(store.vacuum(keep=1, grace=-1)) == 2 and store.read().count() == 1000
    assert KeyedStore(spark, store.root, "k long, v long", keys=["k"], buckets=99).buckets == 8


def test_store_bucket_is_written_by_several_tasks(spark, scratch_dir, own_settings):
    own_settings("spark.sql.shuffle.partitions", "16")
    own_settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    store = KeyedStore(spark, os.path.join(scratch_dir, "s"), "k long, v long", keys=["k"], buckets=2)
    store.upsert(spark.range(4000).selectExpr("id AS k", "id AS v"), 1)
    files = [f for f in store._load([x for f in store.manifest()[1]["folders"].values() for x in f]).inputFiles()]
    assert len(files) > 4 and store.read().count() == 4000


def test_store_writers_meet(spark, scratch_dir, monkeypatch):
    """A compaction and an upsert that started from one version: both are in, whichever publishes first."""
    store = KeyedStore(spark, os.path.join(scratch_dir, "s"), "k long, v long", keys=["k"], buckets=2)
    for seq in (1, 2):
        store.upsert(spark.range(20).select(F.col("id").alias("k"), F.lit(seq).alias("v")), seq)
    commit = published.VersionLog.commit
    met = []

    def slow(self, document, after):
        if not met:
            met.append(1)
            store.upsert(spark.createDataFrame([(3, 30)], "k long, v long"), 3)  # in between
        return commit(self, document, after)

    monkeypatch.setattr(published.VersionLog, "commit", slow)
    store.compact()
    got = {r["k"]: r["v"] for r in store.read().collect()}
    assert got[3] == 30 and got[4] == 2 and len(got) == 20 and met
    assert store.manifest()[1]["applied"] == [[1, 3]]


def test_store_dies_before_publishing(spark, scratch_dir, monkeypatch):
    store = KeyedStore(spark, os.path.join(scratch_dir, "s"), "k long, v long", keys=["k"], buckets=2)
    store.upsert(spark.createDataFrame([(1, 1)], "k long, v long"), 1)
    with monkeypatch.context() as m:
        m.setattr(published.VersionLog, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            store.upsert(spark.createDataFrame([(1, 2)], "k long, v long"), 2)
    assert not store.applied(2) and store.read().first()["v"] == 1
    store.upsert(spark.createDataFrame([(1, 2)], "k long, v long"), 2)
    assert store.read().first()["v"] == 2
    with pytest.raises(ValueError, match="store's own"):
        KeyedStore(spark, store.root, "k long, store_seq long", keys=["k"])


def test_number_ranges():
    for order in itertools.permutations([1, 2, 3, 7, 8, 5]):
        out = []
        for n in order:
            out = add_to_ranges(out, n)
        assert out == [[1, 3], [5, 5], [7, 8]] and add_to_ranges(out, 2) == out


# Staged panels

def test_panels_are_found_again(spark, scratch_dir):
    src, root = os.path.join(scratch_dir, "in put"), os.path.join(scratch_dir, "panels")
    spark.range(100).select("id", (F.col("id") % 7).alias("k")).write.parquet(src)

    def job(limit=50):
        return spark.read.parquet(src).where(F.col("id") < limit).groupBy("k").agg(F.count("*").alias("n"))

    panels = staging.StagedPanels(spark, root)
    first, again = panels.stage(job()), panels.stage(job())
    assert (first[1], again[1]) == (False, True)
    assert sorted(map(tuple, again[0].collect())) == sorted(map(tuple, job().collect()))
    assert "groupBy" not in executed(again[0]) and "HashAggregate" not in executed(again[0])
    assert panels.stage(job(60))[1] is False and panels.stage(job(60))[1] is True  # another plan
    spark.range(100, 120).select("id", (F.col("id") % 7).alias("k")).write.mode("append").parquet(src)
    grown = panels.stage(job(200))
    assert grown[1] is False and sum(r["n"] for r in grown[0].collect()) == 120
    assert panels.stage(job())[1] is False  # the files differ now
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert panels.stage(job())[1] is False
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert panels.stage(job())[1] is True
    assert len(panels.vacuum(older_than=-1)) == 5 and panels.stage(job())[1] is False


def test_panels_of_inputs_that_are_no_files(spark, scratch_dir):
    src = os.path.join(scratch_dir, "in")
    spark.range(10).write.parquet(src)
    rows = spark.read.parquet(src)
    assert staging.fingerprint(rows) == staging.fingerprint(spark.read.parquet(src)) is not None
    local = spark.createDataFrame([(1,), (2,)], "id long")
    for df in (local, rows.unionByName(local), rows.withColumn("r", F.rand()), rows.mapInPandas(lambda b: b, "id long"),
               spark.createDataFrame(rows.rdd, rows.schema)):
        assert staging.fingerprint(df) is None
        assert staging.StagedPanels(spark, os.path.join(scratch_dir, "p")).stage(df)[1] is False
    dated = [staging.fingerprint(rows.withColumn("t", F.current_timestamp())) for _ in range(2)]
    assert dated[0] != dated[1]


# Layout

def test_closing_ranges():
    ranges = layout.closing_ranges("2019-06-15", "2021-12-10")
    assert ranges == [(dt.date(2017, 12, 1), dt.date(2017, 12, 31)), (dt.date(2018, 12, 1), dt.date(2018, 12, 31)),
                      (dt.date(2019, 12, 1), dt.date(2019, 12, 31)), (dt.date(2020, 12, 1), dt.date(2020, 12, 31)),
                      (dt.date(2021, 12, 1), dt.date(2021, 12, 10))]
    assert layout.closing_ranges("2020-01-31", "2020-02-10", 29, None) == [(dt.date(2017, 8, 31), dt.date(2020, 2, 10))]
    assert layout.closing_ranges("2020-06-01", "2020-07-01", 0) == [] == layout.closing_ranges("2021-01-01", "2020-01-01", 0, None)
    assert layout.closing_ranges("2020-03-31", "2020-12-31", 1, 2) == [(dt.date(2020, 2, 29), dt.date(2020, 2, 29))]


@pytest.fixture(scope="module")
def monthly(spark):
    """Statements of every month of six years."""
    return spark.range(36_000).select((F.col("id") % 500).alias("party_id"),
                                      F.expr("add_months(DATE'2015-01-31', CAST(id div 500 AS INT))").alias("data_date"),
                                      F.rand(3).alias("A_1"))


def test_window_scan_of_a_clustered_table(spark, scratch_dir, monthly):
    table = layout.ClusteredStatements(spark, os.path.join(scratch_dir, "t"))
    with pytest.raises(FileNotFoundError):
        table.stats()
    table.write(monthly, files=144)
    window = ("2018-06-15", "2019-12-31")
    plain = os.path.join(scratch_dir, "plain")
    monthly.repartition(24).write.parquet(plain)
    old, new = scan_statements_window(spark.read.parquet(plain), *window), table.scan(*window)
    want = sorted(map(tuple, old.collect()))
    assert sorted(map(tuple, new.collect())) == want and len(want) == 4 * 500
    assert metric(old, "Scan", "numFiles") == 24 and metric(new, "Scan", "numFiles") <= 16 < table.stats().count()
    assert metric(new, "Scan", "numOutputRows") <= 4000 < metric(old, "Scan", "numOutputRows")
    assert sum(r["rows"] for r in table.stats().collect()) == 36_000
    assert "GreaterThanOrEqual(data_date,2016-12-01)" in executed(new)
    one = table.scan(*window, parties=(7, 9))
    assert sorted(map(tuple, one.collect())) == [r for r in want if 7 <= r[0] <= 9]
    assert metric(one, "Scan", "numFiles") < metric(new, "Scan", "numFiles")
    assert table.scan("2030-01-01", "2031-01-01", 0).count() == 0 and table.scan("2018-06-15", "2018-07-01", 0).count() == 0


def test_row_groups_are_skipped(spark, scratch_dir, monthly):
    """One file: the ranges skip row groups, the month test can't."""
    table = layout.ClusteredStatements(spark, os.path.join(scratch_dir, "t"))
    table.write(monthly, files=1, row_group_bytes=16 << 10)
    path = f"{table._latest()[0]}/rows"
    window = ("2018-06-15", "2019-12-31")
    by_month, by_range = (f(spark.read.parquet(path), *window) for f in (scan_statements_window, layout.scan_closing_months))
    assert sorted(map(tuple, by_month.collect())) == sorted(map(tuple, by_range.collect()))
    assert metric(by_range, "Scan", "numOutputRows") < 0.5 * metric(by_month, "Scan", "numOutputRows")


def test_clustered_table_with_null_dates(spark, scratch_dir):
    rows = spark.createDataFrame([(1, None, 1.0), (None, dt.date(2019, 12, 31), 2.0), (2, dt.date(2019, 12, 31), 3.0)],
                                 "party_id long, data_date date, A_1 double")
    table = layout.ClusteredStatements(spark, os.path.join(scratch_dir, "t"))
    table.write(rows, files=2)
    assert sorted(r["A_1"] for r in table.scan("2019-12-01", "2019-12-31", 0).collect()) == [2.0, 3.0]
    table.write(rows.limit(0))
    assert table.scan("2019-12-01", "2019-12-31").count() == 0
