"""Pairing, grids and forward fill on hand-written rows."""

import datetime as dt


from tallyframe.operators.panel import (
    dedupe_latest, forward_fill, month_grid, pair_prev, pair_prev_lag, year_grid, year_panel,
)


def d(y, m=12, day=31):
    return dt.date(y, m, day)


def stmts(spark, rows):
    return spark.createDataFrame(rows, "party_id long, data_date date, A double, B double")


def test_pair_prev_flag(spark):
    rows = [(1, d(2019), 0, 10.0, 1.0), (1, d(2019), 1, 8.0, 2.0),   # pair
            (2, d(2019), 0, 5.0, None),                             # no flag 1
            (3, d(2019), 1, 7.0, 7.0),                              # flag 1 only -> no row
            (4, d(2019), 0, 1.0, 1.0), (4, d(2019), 0, 3.0, 0.0),   # duplicate flag 0
            (5, d(2019), 2, 9.0, 9.0)]                              # other flag ignored
    df = spark.createDataFrame(rows, "party_id long, data_date date, prev_financial_indicator int, A double, B double")
    out = {r.party_id: r for r in pair_prev(df, ["A"], ["A", "B"]).collect()}
    assert set(out) == {1, 2, 4}
    assert (out[1].A, out[1].B, out[1].A_prev) == (10.0, 1.0, 8.0)
    assert out[2].A_prev is None
    assert out[4].A == 3.0 and out[4].B == 0.0   # largest row wins, whole row kept


def test_year_grid_and_lag(spark):
    rows = [(1, d(2018), 1.0, 1.0), (1, d(2020), 3.0, 3.0),      # 2019 missing
            (2, d(2019, 6, 30), 5.0, 5.0),                       # off December: vanishes
            (3, d(2019), 7.0, None)]
    df = stmts(spark, rows)
    grid = sorted((r.party_id, r.data_date) for r in year_grid(df).collect())
    assert grid == [(p, d(y)) for p in (1, 2, 3) for y in (2018, 2019, 2020)]
    out = {(r.party_id, r.data_date.year): r for r in pair_prev_lag(df, ["A"]).collect()}
    assert out[(1, 2018)].A_prev is None
    assert out[(1, 2019)].A is None and out[(1, 2019)].A_prev == 1.0
    assert out[(1, 2020)].A_prev is None            # previous grid row has no statement
    assert out[(2, 2019)].A is None                 # off-December row is not on the grid
    assert out[(3, 2020)].A_prev == 7.0


def test_year_panel_duplicates_deterministic(spark):
    rows = [(1, d(2019), 1.0, 9.0), (1, d(2019), 2.0, 0.0)]
    out = year_panel(stmts(spark, rows)).collect()
    assert len(out) == 1 and (out[0].A, out[0].B) == (2.0, 0.0)
    assert dedupe_latest(stmts(spark, rows)).collect()[0].A == 2.0


def test_month_grid(spark):
    rows = [(1, d(2020, 1, 15), 1.0, None), (1, d(2020, 3, 2), None, 2.0)]
    g = sorted(r.data_date for r in month_grid(stmts(spark, rows)).collect())
    assert g[0] == d(2020, 1, 1) and g[-1] == d(2021, 3, 1) and len(g) == 15


def test_forward_fill_horizon(spark):
    rows = [(1, d(2020, 1, 20), 5.0, None)]
    out = {r.data_date: r.A for r in forward_fill(stmts(spark, rows)).collect()}
    assert len(out) == 13
    assert all(v == 5.0 for v in out.values())            # filled through 2021-01
    rows.append((1, d(2021, 1, 3), None, 1.0))            # a later row with null A
    out = {r.data_date: (r.A, r.B) for r in forward_fill(stmts(spark, rows)).collect()}
    assert out[d(2021, 1, 1)] == (5.0, 1.0)               # 12 months after: still filled
    assert out[d(2021, 2, 1)] == (None, 1.0)              # 13 months: forgotten
    assert max(out) == d(2022, 1, 1)


def test_forward_fill_newer_value_wins(spark):
    rows = [(1, d(2020, 1, 1), 1.0, None), (1, d(2020, 4, 1), 2.0, None), (2, d(2020, 1, 1), None, 3.0)]
    out = {(r.party_id, r.data_date): r for r in forward_fill(stmts(spark, rows)).collect()}
    assert out[(1, d(2020, 3, 1))].A == 1.0 and out[(1, d(2020, 5, 1))].A == 2.0
    assert out[(2, d(2020, 6, 1))].B == 3.0 and out[(2, d(2020, 6, 1))].A is None


def test_forward_fill_blocks_do_not_change_result(spark):
    from tallyframe.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    sparse = fx.sparse(spark, SF_SMALL)
    small = forward_fill(sparse, block_months=13)
    large = forward_fill(sparse, block_months=1200)
    a = sorted(map(tuple, small.collect()))
    b = sorted(map(tuple, large.collect()))
    assert a == b and len(a) > 0


def test_duplicates_and_null_keys_do_not_depend_on_order(spark):
    rows = [(1, d(2020, 1, 5), 1.0, None), (1, d(2020, 1, 9), 2.0, 3.0), (None, d(2020, 1, 9), 4.0, 4.0),
            (1, None, 9.0, 9.0)]
    fills = [sorted(map(tuple, forward_fill(stmts(spark, r)).collect()), key=str) for r in (rows, rows[::-1])]
    assert fills[0] == fills[1]
    by_party = {p: {r[2:] for r in fills[0] if r[0] == p} for p in (1, None)}
    assert by_party == {1: {(2.0, 3.0)}, None: {(None, None)}}


def test_pair_prev_null_key_matches_nothing(spark):
    df = spark.createDataFrame([(1, None, 0, 10.0), (1, None, 1, 5.0)],
                               "party_id long, data_date date, prev_financial_indicator int, A double")
    assert [tuple(r) for r in pair_prev(df, ["A"], ["A"]).collect()] == [(1, None, 10.0, None)]
