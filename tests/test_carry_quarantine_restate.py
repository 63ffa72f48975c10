"""Forward fill with a carry, quarantine of bad rows, recompute after restated accounts."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.catalog import Catalog, Custom, Ratio
from tallyframe.operators import formulas
from tallyframe.operators.features import compute_features
from tallyframe.operators.fill_carry import forward_fill_carry
from tallyframe.operators.panel import forward_fill
from tallyframe.operators.restate import account_index, affected_features, inputs_of, recompute, recompute_changed
from tallyframe.sources.quarantine import checked_columns, write_checked
from tallyframe.sources.readers import map_columns
from tallyframe.sources.sinks import stage_panel
from tallyframe.sources.schema import ACCOUNT_CODES


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def executed(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


# Carry

def series(seed):
    rng = random.Random(seed)
    out = []
    for p in (1, 2, 3, None):
        month = rng.randrange(24_000, 24_020)
        for _ in range(rng.randrange(1, 9)):
            day = dt.date(month // 12, month % 12 + 1, rng.randrange(1, 28))
            for _ in range(rng.choice([1, 1, 2])):
                out.append((p, day, rng.choice([None, rng.randrange(100)]), rng.choice([None, None, f"s{rng.randrange(9)}"])))
            month += rng.choice([1, 2, 5, 13, 40, 90])
    return [*out, (9, None, 5, "no date")]


@pytest.mark.parametrize("seed", range(4))
def test_carry_equals_the_halo_fill(spark, seed):
    df = spark.createDataFrame(series(seed), "party_id long, data_date date, a int, b string")
    for months, extend, block in ((12, 12, 60), (12, 0, 5), (30, 7, 7), (0, 3, 1), (200, 12, 13)):
        got = forward_fill_carry(df, months=months, extend=extend, block_months=block)
        want = forward_fill(df, months=months, extend=extend)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert rows(got) == rows(want), (seed, months, extend, block)


def test_carry_over_blocks_shorter_than_the_months(spark):
    """A value reaches over blocks without observations, and is forgotten to the month."""
    df = spark.createDataFrame([(1, dt.date(2000, 1, 31), 7), (1, dt.date(2004, 1, 31), 8)], "party_id long, data_date date, v int")
    got = {r["data_date"]: r["v"] for r in forward_fill_carry(df, months=30, extend=2, block_months=4).collect()}
    assert len(got) == 51 and got[dt.date(2002, 7, 1)] == 7 and got[dt.date(2002, 8, 1)] is None and got[dt.date(2004, 3, 1)] == 8


def test_carry_plan_and_names(spark):
    df = spark.createDataFrame([(1, dt.date(2000, 1, 31), 7, 1, 2)], "party_id long, data_date date, block int, grid_month int, last_block int")
    assert forward_fill_carry(df, extend=0).collect()[0].asDict() == {
        "party_id": 1, "data_date": dt.date(2000, 1, 1), "block": 7, "grid_month": 1, "last_block": 2}
    assert forward_fill_carry(df.limit(0)).count() == 0
    plan = executed(forward_fill_carry(df))
    assert "Join" not in plan and "array(" not in plan  # no join, no rows copied into a second block


# Quarantine

RAW = "Party_Id string, DATA_DATE string, Prev_Financial_Indicator string, a_1 string, p_main double, p_adj string"
MAPPING = {"A_1": "A_1", "P_47": "p_main + p_adj"}
GIVEN = [("1", "2020-12-31", "0", "5.5", 1.0, "2"), ("x1", "2020-12-31", "0", "1", 1.0, "1"), ("2", "31.31.2020", "0", "1", 1.0, None),
         ("3", "20201231", "yes", "1", 1.0, "1"), ("4", "31.12.2020", "1", "1,5", 1.0, "n/a"), (None, None, None, None, None, None),
         ("5", " ", "", "  ", None, ""), ("6", "2020-12-31", "0", "NaN", 2.0, "1")]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(GIVEN, RAW)


def test_malformed_values_are_named(raw):
    got = checked_columns(raw, ["A_1", "P_47"], MAPPING)
    assert [r["malformed"] for r in got.collect()] == [
        [], ["party_id"], ["data_date"], ["prev_financial_indicator"], ["A_1", "P_47"], [], [], []]
    texts = [r["raw_row"] for r in got.collect()]
    assert [t is not None for t in texts] == [False, True, True, True, True, False, False, False]
    assert json.loads(texts[2]) == dict(zip(["Party_Id", "DATA_DATE", "Prev_Financial_Indicator", "a_1", "p_main", "p_adj"], GIVEN[2]))
    mapped = map_columns(raw, ["A_1", "P_47"], MAPPING)
    assert got.columns[:-2] == mapped.columns and str(got.drop("malformed", "raw_row").collect()) == str(mapped.collect())


def test_one_job_writes_both_kinds_and_counts(spark, raw, scratch_dir):
    src = os.path.join(scratch_dir, "raw")
    raw.write.parquet(src)
    table = spark.read.parquet(src)
    seen = checked_columns(table, ["A_1", "P_47"], MAPPING)
    assert executed(seen).count("FileScan") == 1
    done = write_checked(table, os.path.join(scratch_dir, "out"), ["A_1", "P_47"], MAPPING)
    assert done.counts == {"rows": 8, "rows with malformed values": 4, "party_id": 1, "data_date": 1, "prev_financial_indicator": 1, "A_1": 1, "P_47": 1}
    assert sorted(r["party_id"] or 0 for r in done.rows.collect()) == [0, 1, 4, 5, 6]  # malformed amounts only: the row stays
    assert sorted(r["malformed"] for r in done.rejected.collect()) == [["A_1", "P_47"], ["data_date"], ["party_id"], ["prev_financial_indicator"]]
    strict = write_checked(table, os.path.join(scratch_dir, "strict"), ["A_1", "P_47"], MAPPING, strict=True)
    assert sorted(r["party_id"] or 0 for r in strict.rows.collect()) == [0, 1, 5, 6] and strict.rejected.count() == 4
    none = write_checked(table.limit(0), os.path.join(scratch_dir, "none"), ["A_1"], MAPPING)
    assert none.rows.count() == none.rejected.count() == 0 and none.counts["rows"] == 0


def test_types_that_need_no_parsing(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 12, 31), 0, 2.0)], "party_id long, data_date date, prev_financial_indicator int, A_1 double")
    got = checked_columns(df, ["A_1"], {}, parse_dates=False).collect()
    assert got[0]["malformed"] == [] and got[0]["data_date"] == dt.date(2020, 12, 31) and got[0]["A_1"] == 2.0


def test_only_columns_that_can_be_malformed_are_tested(spark, scratch_dir):
    """Amounts of a number type need no test a row; their count is 0, and a type with room for bad values keeps its test."""
    table = spark.createDataFrame([("1", "20201231", 0, 1.5, 2, "3"), ("x", "20201231", 1, None, None, "n/a"), ("2", "bad", 0, float("nan"), 4, " ")],
                                  "party_id string, data_date string, prev_financial_indicator int, A_1 double, A_10 int, A_15 string")
    table = table.withColumn("A_10", F.col("A_10").cast("decimal(9,2)"))
    accounts = ["A_1", "A_10", "A_15"]
    checked = checked_columns(table, accounts, {})
    assert [r["malformed"] for r in checked.collect()] == [[], ["party_id", "A_15"], ["data_date"]]
    plan = executed(checked)
    assert "ArrayFilter" not in plan and "filter(array" not in plan and "THEN A_1 " not in plan and "THEN A_10" not in plan and "THEN A_15" in plan
    done = write_checked(table, os.path.join(scratch_dir, "typed"), accounts, {})
    assert done.counts == {"rows": 3, "rows with malformed values": 2, "party_id": 1, "data_date": 1, "prev_financial_indicator": 0, "A_1": 0, "A_10": 0, "A_15": 1}
    assert done.rows.count() == 1 and done.rejected.count() == 2
    clean = table.selectExpr("1L AS party_id", "DATE'2020-12-31' AS data_date", "prev_financial_indicator", "A_1")
    done = write_checked(clean, os.path.join(scratch_dir, "clean"), ["A_1"], {})
    assert done.rows.count() == 3 and done.rejected.count() == 0 and set(done.counts.values()) == {0, 3}
    # A party too large for its type is malformed, though it is a number.
    large = clean.withColumn("party_id", F.lit(1e30))
    assert {tuple(r["malformed"]) for r in checked_columns(large, ["A_1"], {}).collect()} == {("party_id",)}


# Restated accounts

def test_account_index_reaches_through_ratios(spark):
    cat = Catalog.default()
    index = account_index(cat)
    assert set(index) == set(cat.accounts()) and all(a in cat.raw_dependencies(n) for a, ns in index.items() for n in ns)
    formulas.register_formula("T_GROWTH", lambda c, p: (c("A_1"), p("A_2")))
    try:
        own = Catalog([*cat, Ratio("T_TOP", "T_GROWTH", cat.family("LQ_")[0]), Custom("T_GROWTH", ())])
        assert {"T_TOP", "T_GROWTH"} <= set(affected_features(["A_2"], own)) and "A_2_prev" in inputs_of(["T_TOP"], own)
        assert affected_features(["A_2"], own, ["T_TOP"]) == ["T_TOP"] and affected_features(["no such"], own) == []
    finally:
        formulas._REGISTRY.pop("T_GROWTH")


def statements(spark, n=60):
    cat = Catalog.default()
    shift = [f"{c}_prev" for c in cat.shifted_accounts()]
    rng = random.Random(4)
    data = [(p, dt.date(2020, 12, 31), *[rng.choice([None, 0.0, float(rng.randrange(1000)) / 8]) for _ in (*ACCOUNT_CODES, *shift)]) for p in range(n)]
    cols = ", ".join(f"`{c}` double" for c in (*ACCOUNT_CODES, *shift))
    return spark.createDataFrame(data, f"party_id long, data_date date, {cols}")


def test_recompute_equals_a_full_run(spark, scratch_dir):
    cat, path = Catalog.default(), os.path.join(scratch_dir, "st")
    statements(spark).write.parquet(path)
    paired = spark.read.parquet(path)
    stored = compute_features(paired, cat)
    changed = ["A_15", "P_3"]
    touched = paired.where("party_id % 4 = 1").withColumns({c: F.col(c) + 10 for c in changed})
    # A restated account counts for last year's figures of the same rows too.
    touched = touched.withColumns({f"{c}_prev": F.col(f"{c}_prev") - 3 for c in changed if f"{c}_prev" in paired.columns})
    full = compute_features(paired.where("party_id % 4 <> 1").unionByName(touched), cat)
    got = recompute(stored, touched, changed, cat)
    assert got.columns == stored.columns and rows(got) == rows(full)
    # Only the affected features' inputs are read, and only those features are computed.
    fresh = recompute_changed(touched, ["A_151"], cat)
    hit = affected_features(["A_151"], cat)
    assert fresh.columns == ["party_id", "data_date", *hit] and 0 < len(hit) < 40
    scan = next(line for line in executed(fresh).splitlines() if "FileScan" in line)
    read = scan.split("ReadSchema: struct<")[1].split(">")[0].replace("`", "")
    assert {c.split(":")[0] for c in read.split(",")} == {"party_id", "data_date", *inputs_of(hit, cat)}
    assert recompute(stored, touched, ["no such account"], cat) is stored


def test_recompute_moves_no_staged_rows(spark):
    cat = Catalog.default()
    name = "Financial_Aggregate_1"
    accounts = inputs_of([name], cat)
    rows = spark.range(200).selectExpr("id AS party_id", "make_date(CAST(2000 + id % 10 AS INT), 12, 31) AS data_date", *(f"CAST(id AS DOUBLE) AS `{c}`" for c in accounts))
    stored = stage_panel(compute_features(rows, cat, [name]), bucket_by=["party_id", "data_date"])
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged_")]
    put = recompute(stored, rows.where("party_id % 5 = 0").withColumn(accounts[0], F.lit(7.0)), [accounts[0]], cat)
    plan = put._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ShuffledHashJoin" in plan  # only the restated rows move
    got = {r["party_id"]: r[name] for r in put.collect()}
    plain = {r["party_id"]: r[name] for r in compute_features(rows, cat, [name]).collect()}
    assert len(got) == 200 and all((got[k] == plain[k]) == (k % 5 != 0) for k in got if k != 7)


def test_recompute_of_some_features_and_odd_keys(spark):
    cat = Catalog.default()
    paired = statements(spark, 6)
    names = [n for n in affected_features(["A_1"], cat) if cat[n].kind == "aggregate"][:2] + cat.family("LQ_")[:1]
    stored = compute_features(paired, cat, names).unionByName(
        compute_features(paired.where("party_id = 0").withColumn("party_id", F.lit(None).cast("long")), cat, names))
    touched = paired.where("party_id < 2").withColumn("A_1", F.lit(1.0)).unionByName(
        paired.where("party_id = 3").withColumn("party_id", F.lit(77).cast("long")))  # a filing that is not stored
    got = recompute(stored, touched, ["A_1"], cat)
    assert got.count() == 7 and got.where("party_id = 77").count() == 0
    want = compute_features(paired.withColumn("A_1", F.when(F.col("party_id") < 2, 1.0).otherwise(F.col("A_1"))), cat, names)
    assert rows(got.where("party_id is not null")) == rows(want)
