"""Registered queries against their DuckDB oracle on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

FAST = ["pair_prev_flag", "pair_prev_lag", "year_grid", "agg_features", "ratio_lq", "custom_flag",
        "custom_lag", "normalize_multiply", "normalize_divide", "config_features", "forward_fill",
        "null_audit", "coverage_report", "map_columns", "restrict_to_spine", "attach_prev_month_end",
        "flagship", "pair_prev_flag_dirty", "forward_fill_dup", "map_columns_dirty", "normalize_divide_dirty",
        "attach_prev_month_end_dirty", "coverage_report_unpaired", "null_audit_all", "yearly_job", "write_table"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF_SMALL) / f"{t}.parquet"
        if p.exists():
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.fixture(scope="module")
def entry_module():
    import __spark_entry__
    return __spark_entry__


def test_every_query_has_an_oracle(entry_module):
    from oracle.queries import build
    from tallyframe.plans.registry import QUERIES

    assert set(QUERIES) == set(build())
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, entry_module, name):
    df = entry_module.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry_module.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)


def test_entry_smoke(spark, entry_module):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["party_id", "data_date"] and len(df.columns) == 2 + 474
