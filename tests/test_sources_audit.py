"""Sources, normalisation, spines, sinks and audits on hand-written rows."""

import datetime as dt
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.scalar import parse_date_any
from tallyframe.operators.audit import coverage_report, filter_month, null_audit
from tallyframe.operators.normalize import normalize_amounts
from tallyframe.operators.spine import attach_prev_month_end, attach_to_spine, restrict_to_spine
from tallyframe.sources.readers import map_columns, scan_statements_window
from tallyframe.sources.sinks import OPEN_BUCKETS, _unsorted_buckets, stage_panel, write_features


def test_parse_date_any(spark):
    df = spark.createDataFrame([("20191231",), ("2019-12-31",), ("31.12.2019",), ("x",), (None,)], "s string")
    got = [r.d for r in df.select(parse_date_any("s").alias("d")).collect()]
    assert got == [dt.date(2019, 12, 31)] * 3 + [None, None]


def test_map_columns_case_insensitive_and_split(spark):
    df = spark.createDataFrame([(7, "31.12.2019", 0, 1.5, 2.0, 0.5, 9.0)],
                               "PARTY_ID long, Data_Date string, PREV_financial_indicator int, "
                               "Revolving_ASSET_1 double, p_47_a double, p_47_b double, g_600 double")
    out = map_columns(df, ["A_1", "P_47", "G_600", "P_3"], {"A_1": "revolving_asset_1", "P_47": "p_47_a + p_47_b"})
    r = out.collect()[0]
    assert out.columns == ["party_id", "data_date", "prev_financial_indicator", "A_1", "G_600", "P_47"]
    assert (r.party_id, r.data_date, r.A_1, r.P_47, r.G_600) == (7, dt.date(2019, 12, 31), 1.5, 2.5, 9.0)
    with pytest.raises(ValueError):
        map_columns(df.drop("Data_Date"), ["A_1"])
    with pytest.raises(ValueError):
        map_columns(df, ["P_3"], {}, skip_missing=False)


def test_scan_window(spark):
    dates = [dt.date(2017, 1, 31), dt.date(2016, 12, 31), dt.date(2017, 12, 31), dt.date(2019, 12, 31),
             dt.date(2019, 6, 30), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(dates)], "party_id long, data_date date")
    got = sorted(r.data_date for r in scan_statements_window(df, "2019-06-15", "2019-12-31").collect())
    assert got == [dt.date(2017, 12, 31), dt.date(2019, 12, 31)]   # from 2017-01-15, December only


def test_normalize_missing_and_zero_rates(spark):
    st = spark.createDataFrame([(1, dt.date(2019, 12, 31), 10.0), (2, dt.date(2020, 12, 31), 10.0),
                                (3, dt.date(2021, 12, 31), 10.0)], "party_id long, data_date date, A double")
    idx = spark.createDataFrame([(201911, 2.0), (201912, 4.0), (202011, 0.0), (202012, 0.0), (202111, 5.0)],
                                "year_month int, inflation_rate double")
    mul = {r.party_id: r.A for r in normalize_amounts(st, idx, ["A"], mode="multiply").collect()}
    div = {r.party_id: r.A for r in normalize_amounts(st, idx, ["A"], mode="divide").collect()}
    assert mul == {1: 20.0, 2: 0.0, 3: 50.0}        # previous month's rate; zero rate -> 0
    assert div == {1: 2.5, 2: 10.0, 3: 10.0}        # same month; zero / missing -> unscaled
    st2 = st.withColumn("data_date", F.lit(dt.date(2022, 12, 31)))
    assert all(r.A is None for r in normalize_amounts(st2, idx, ["A"], mode="multiply").collect())
    rebased = {r.party_id: r.A for r in normalize_amounts(st, idx, ["A"], base_month=201912).collect()}
    assert rebased[1] == 10.0


def test_spine_joins(spark):
    st = spark.createDataFrame([(1, dt.date(2019, 12, 31), 1.0), (2, dt.date(2019, 12, 31), 2.0)],
                               "party_id long, data_date date, A double")
    spine = spark.createDataFrame([(1, dt.date(2019, 12, 31)), (1, dt.date(2019, 12, 31)), (3, dt.date(2019, 12, 31))],
                                  "party_id long, data_date date")
    assert [r.party_id for r in restrict_to_spine(st, spine).collect()] == [1]
    att = sorted((r.party_id, r.A) for r in attach_to_spine(spine.distinct(), st).collect())
    assert att == [(1, 1.0), (3, None)]
    ms = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-06-01"), (2, "2020-01-01")],
                               "party_id long, month_start string")
    pm = sorted((r.party_id, r.month_start, r.A) for r in
                attach_prev_month_end(ms, st, party_type="decimal(16,0)").collect())
    assert pm == [(1, "2020-01-01", 1.0), (1, "2020-06-01", None), (2, "2020-01-01", 2.0)]


def test_null_audit_matches_full_outer_join(spark):
    k = dt.date(2020, 6, 30)
    model = spark.createDataFrame([(1, k, None), (1, k, 1.0), (2, k, None), (None, k, None), (4, k, 1.0)],
                                  "party_id long, data_date date, x double")
    source = spark.createDataFrame([(1, k, None), (1, k, None), (1, k, 2.0), (3, k, None), (None, k, 5.0)],
                                   "party_id long, data_date date, y double")
    got = null_audit(model, source, [("x", "y")]).collect()[0]
    j = model.alias("m").join(source.alias("s"), ["party_id", "data_date"], "full_outer")
    exp = j.agg(F.count_if(F.col("m.x").isNull()).alias("a"), F.count_if(F.col("s.y").isNull()).alias("b"),
                F.count_if(F.col("m.x").isNull() & F.col("s.y").isNull()).alias("c")).collect()[0]
    assert (got.model_nulls, got.source_nulls, got.both_null) == (exp.a, exp.b, exp.c)
    assert filter_month(model, "2020-06").count() == 5 and filter_month(model, "2020-07").count() == 0


def test_coverage_report(spark):
    from tallyframe.catalog import Catalog
    df = spark.createDataFrame([(1, dt.date(2019, 12, 31), 1.0, 2.0), (2, dt.date(2019, 12, 31), None, 2.0)],
                               "party_id long, data_date date, A_1 double, P_3 double")
    rep = {r.feature: r for r in coverage_report(df, Catalog.default()).collect()}
    assert len(rep) == 474
    assert rep["LQ_01"].status == "calculable" and rep["LQ_01"].complete_rows == 1
    assert rep["Financial_Aggregate_7"].complete_rows == 2
    assert rep["DC_01"].status == "skipped" and "G_692" in rep["DC_01"].missing_accounts
    assert rep["DC_01"].complete_rows is None


def test_sinks_round_trip(spark, scratch_dir):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "party_id long, v double")
    staged = stage_panel(df)
    assert sorted(r.party_id for r in staged.collect()) == [1, 2]
    path = os.path.join(scratch_dir, "out")
    write_features(df, path)
    assert spark.read.parquet(path).count() == 2
    write_features(df, "tallytest.features", fmt="orc")
    assert spark.table("tallytest.features").count() == 2


def test_staged_buckets_are_not_sorted(spark, own_settings):
    """A task keeps its few buckets open; one with more of them still puts every row where it belongs."""
    own_settings("spark.sql.shuffle.partitions", str(3 * OPEN_BUCKETS))
    own_settings("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    rows = spark.range(500).selectExpr("id AS party_id", "CAST(id AS DOUBLE) AS v")
    staged = stage_panel(rows.coalesce(1), bucket_by=["party_id"])
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, rows.collect()))
    by_key = staged.groupBy("party_id").agg(F.sum("v").alias("v"))
    assert "Exchange" not in by_key._jdf.queryExecution().executedPlan().toString() and by_key.count() == 500
    spark.sql("CREATE DATABASE IF NOT EXISTS tallytest")
    spark.sql("CREATE TABLE tallytest.few_buckets (party_id BIGINT, v DOUBLE) USING parquet CLUSTERED BY (party_id) INTO 4 BUCKETS")
    plan = "EXPLAIN INSERT INTO tallytest.few_buckets SELECT id, CAST(id AS DOUBLE) FROM range(9)"
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert "Sort [" in spark.sql(plan).first()[0]
    with _unsorted_buckets(spark):
        assert "Sort [" not in spark.sql(plan).first()[0]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_staging_lets_its_shuffle_files_go(spark):
    local = Path(spark.sparkContext.getConf().get("spark.local.dir"))
    files = lambda: {p.name for p in local.rglob("shuffle_*.data")}
    there = files()
    newest = max((int(n.split("_")[1]) for n in there), default=-1)
    staged = stage_panel(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    end = time.time() + 20
    while (left := {n for n in files() if int(n.split("_")[1]) > newest}) and time.time() < end:
        time.sleep(0.2)
    assert not left and staged.count() == 7


def test_bucketed_features_join_without_shuffle(spark):
    df = spark.createDataFrame([(i % 50, dt.date(2019, 12, 31), float(i)) for i in range(400)],
                               "party_id long, data_date date, v double")
    write_features(df, "tallytest.bucketed", bucket_by=["party_id"], num_buckets=4)
    t = spark.table("tallytest.bucketed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force a sort-merge join
    try:
        joined = t.alias("a").join(t.alias("b"), "party_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert joined.count() == 400 * 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_config_job_missing_rate_and_spine(spark):
    from tallyframe.catalog import ConfigFeature
    from tallyframe.plans.pipelines import config_job
    feats = [ConfigFeature("n", numerator=("A_1",)), ConfigFeature("r", numerator=("A_1",), denominator=("P_3",))]
    st = spark.createDataFrame([(1, "31.12.2019", 0, 10.0, 5.0), (2, "31.12.2020", 0, 10.0, 5.0)],
                               "party_id long, close_date string, prev_financial_indicator int, A_1 double, P_3 double")
    spine = spark.createDataFrame([(1, dt.date(2019, 12, 31)), (2, dt.date(2020, 12, 31)), (3, dt.date(2020, 12, 31))],
                                  "party_id long, data_date date")
    idx = spark.createDataFrame([(201911, 2.0)], "year_month int, inflation_rate double")   # no rate for 2020-11
    out = {r.party_id: r for r in config_job(spine, st, feats, idx).collect()}
    assert (out[1].n, out[1].r) == (20.0, 2.0)          # both scaled by the previous month's rate
    assert (out[2].n, out[2].r) == (0.0, None)          # missing rate -> null amounts -> 0 / null
    assert (out[3].n, out[3].r) == (None, None)         # spine key without a statement


def test_bucketed_table_has_a_file_per_bucket(spark):
    df = spark.range(0, 2000, 1, 16).selectExpr("id AS party_id", "CAST(id AS DOUBLE) AS v")
    write_features(df, "tallytest.bucketed", bucket_by=["party_id"], num_buckets=4)
    assert len(spark.table("tallytest.bucketed").inputFiles()) <= 4
    assert spark.table("tallytest.bucketed").count() == 2000


def test_large_buckets_are_several_tasks(spark, own_settings):
    own_settings("spark.sql.shuffle.partitions", "16")
    own_settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_features(spark.range(4000).withColumnRenamed("id", "party_id"), "tallytest.shared_buckets", bucket_by=["party_id"], num_buckets=2)
    t = spark.table("tallytest.shared_buckets")
    assert 4 < len(t.inputFiles()) <= 16 and t.count() == t.distinct().count() == 4000


def test_partitioned_write(spark, scratch_dir):
    path = os.path.join(scratch_dir, "parts")
    df = spark.range(0, 100, 1, 8).selectExpr("id", "id % 3 AS y")
    write_features(df, path, partition_by=["y"])
    back = spark.read.parquet(path)
    assert back.count() == 100 and len(back.inputFiles()) == 3


def test_index_of_unreal_months_and_nan_rates(spark):
    from tallyframe.operators.normalize import monthly_index, normalize_amounts
    idx = spark.createDataFrame([(201912, float("nan")), (201913, 2.0), (99, 2.0), (None, 2.0), (201911, 4.0)],
                                "year_month int, inflation_rate double")
    assert {r[0] for r in monthly_index(idx).collect()} == {201912, 201911}
    df = spark.createDataFrame([(1, dt.date(2019, 12, 31), 8.0), (1, dt.date(2019, 11, 30), 8.0)],
                               "party_id long, data_date date, A double")
    kept = {r.data_date.month: r.A for r in normalize_amounts(df, idx, ["A"]).collect()}
    assert kept == {12: 8.0, 11: 2.0}
    base = {r.data_date.month: r.A for r in normalize_amounts(df, idx, ["A"], base_month=201911).collect()}
    assert base == {12: 8.0, 11: 8.0}  # no rate in December: unscaled
