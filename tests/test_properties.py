"""Properties: row order, early spine restriction and hot duplicate keys change nothing."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyframe.catalog import Catalog
from tallyframe.operators.audit import null_audit
from tallyframe.operators.features import compute_features
from tallyframe.operators.panel import pair_prev
from tallyframe.operators.spine import attach_to_spine
from tallyframe.plans.pipelines import paired_statements, spine_job
from tallyframe.sources import fixtures as fx
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_row_order_does_not_matter(spark):
    cat = Catalog.default()
    names = cat.family("LQ_") + [f.name for f in cat.of_kind("custom")]
    fl = fx.statements_flagged(spark, SF_SMALL)
    shuffled = fl.repartition(5).orderBy(F.rand(11))
    a = compute_features(paired_statements(fl, cat, names), cat, names)
    b = compute_features(paired_statements(shuffled, cat, names), cat, names)
    assert rows(a) == rows(b)


def test_restrict_before_or_after_spine(spark):
    cat = Catalog.default()
    fl = fx.statements_flagged(spark, SF_SMALL)
    spine = fx.spine(spark, SF_SMALL)
    early = spine_job(spine, fl, None, cat)
    late = attach_to_spine(spine.select("party_id", "data_date").distinct(),
                           compute_features(paired_statements(fl, cat), cat))
    assert rows(early) == rows(late)


def test_hot_duplicate_key(spark):
    base = [(1, dt.date(2019, 12, 31), 0, 1.0), (1, dt.date(2019, 12, 31), 1, 0.5),
            (2, dt.date(2019, 12, 31), 0, 3.0)]
    hot = base + [(1, dt.date(2019, 12, 31), 0, 1.0)] * 3000 + [(1, dt.date(2019, 12, 31), 1, 0.5)] * 3000
    schema = "party_id long, data_date date, prev_financial_indicator int, A double"
    a = pair_prev(spark.createDataFrame(base, schema), ["A"])
    b = pair_prev(spark.createDataFrame(hot, schema).repartition(8), ["A"])
    assert rows(a) == rows(b)


keys = st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.sampled_from([dt.date(2020, 1, 31), dt.date(2020, 2, 29)]))
vals = st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(keys, vals), max_size=12), st.lists(st.tuples(keys, vals), max_size=12))
def test_null_audit_equals_brute_force(spark, left, right):
    schema_m = "party_id long, data_date date, x double"
    schema_s = "party_id long, data_date date, y double"
    m = spark.createDataFrame([(k[0], k[1], v) for k, v in left], schema_m)
    s = spark.createDataFrame([(k[0], k[1], v) for k, v in right], schema_s)
    got = null_audit(m, s, [("x", "y")]).collect()[0]
    # brute force in Python: full outer join semantics (null keys never match)
    mn = sn = bn = 0
    matched_right = set()
    for i, (kl, vl) in enumerate(left):
        partners = [j for j, (kr, _) in enumerate(right) if None not in kl and kl == kr]
        if partners:
            for j in partners:
                matched_right.add(j)
                vr = right[j][1]
                mn += vl is None
                sn += vr is None
                bn += vl is None and vr is None
        else:
            mn += vl is None
            sn += 1
            bn += vl is None
    for j, (kr, vr) in enumerate(right):
        if j not in matched_right:
            mn += 1
            sn += vr is None
            bn += vr is None
    assert (got.model_nulls, got.source_nulls, got.both_null) == (mn, sn, bn)
