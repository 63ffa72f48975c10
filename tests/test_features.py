"""Feature operators on hand-written rows: null rules, zero denominators, properties."""

import datetime as dt
import math

import pytest

from tallyframe.catalog import Catalog, ConfigFeature
from tallyframe.operators.features import (
    compute_features, config_features, custom_features, features_long,
)
from tallyframe.operators.formulas import prev_name, register_formula, formula_column
from tallyframe.sources.schema import ACCOUNT_CODES

D = dt.date(2019, 12, 31)


@pytest.fixture(scope="module")
def cat():
    return Catalog.default()


def frame(spark, rows, shifted=()):
    """rows: list of dicts code -> value (missing -> null); keys added."""
    cols = list(ACCOUNT_CODES) + [prev_name(c) for c in shifted]
    schema = "party_id long, data_date date, " + ", ".join(f"`{c}` double" for c in cols)
    data = [(i + 1, D, *[r.get(c) for c in cols]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_all_null_statement(spark, cat):
    out = one(compute_features(frame(spark, [{}], cat.shifted_accounts()), cat))
    for f in cat:
        v = out[f.name]
        if f.kind == "aggregate":
            assert v == 0.0, f.name
        else:
            assert v is None, f.name


def test_zero_denominator_is_null_not_error(spark, cat):
    row = {c: 1.0 for c in ACCOUNT_CODES}
    row["P_3"] = 0.0
    out = one(compute_features(frame(spark, [row]), cat, ["LQ_01", "DC_04", "Financial_Aggregate_7"]))
    assert out["Financial_Aggregate_7"] == 0.0
    assert out["LQ_01"] is None and out["DC_04"] is None


def test_custom_operand_null_propagates(spark, cat):
    row = {c: 2.0 for c in ACCOUNT_CODES}
    row.update({prev_name(c): 1.0 for c in cat.shifted_accounts()})
    row[prev_name("A_15")] = None
    out = one(custom_features(frame(spark, [row], cat.shifted_accounts()), cat))
    for n in ("EF_14", "EF_17", "LQ_50", "EF_13", "LQ_13", "LQ_14"):
        assert out[n] is None, n
    assert out["TR_01"] == 1.0   # (2 - 1) / 1
    assert out["FS_12"] is not None


def test_custom_values_by_hand(spark, cat):
    row = {c: 0.0 for c in ACCOUNT_CODES}
    row.update({prev_name(c): 0.0 for c in cat.shifted_accounts()})
    row.update({"G_60": 150.0, prev_name("G_60"): 100.0, "A_15": 30.0, prev_name("A_15"): 10.0,
                "G_62": 73.0, "P_3": 50.0, "P_331": 10.0, "A_12": 4.0, "A_10": 1.0, "A_11": 1.0})
    out = one(custom_features(frame(spark, [row], cat.shifted_accounts()), cat))
    assert out["TR_01"] == pytest.approx(0.5)
    assert out["EF_17"] == pytest.approx(365 * 40 / 2 / 73)
    assert out["EF_13"] == pytest.approx((150 + 30 - 10) / 30)
    assert out["LQ_50"] == pytest.approx((4 + 1 + 1 + 20) / 40)


def test_aggregate_sign_and_order(spark, cat):
    row = {"P_3": 10.0, "P_4": 5.0, "P_331": 1.0, "P_431": None}
    out = one(compute_features(frame(spark, [row]), cat, ["Financial_Aggregate_3", "DC_20_adj"]))
    assert out["Financial_Aggregate_3"] == 14.0
    assert out["DC_20_adj"] is None  # P_5 null -> aggregate 0 -> null ratio


def test_scaling_property(spark, cat):
    base = {c: float((i * 37) % 101 + 1) for i, c in enumerate(ACCOUNT_CODES)}
    k = 4.0
    scaled = {c: v * k for c, v in base.items()}
    names = [f.name for f in cat.of_kind("aggregate")] + [f.name for f in cat.of_kind("ratio")]
    a = one(compute_features(frame(spark, [base]), cat, names))
    b = one(compute_features(frame(spark, [scaled]), cat, names))
    for n in names:
        if cat[n].kind == "aggregate":
            assert b[n] == pytest.approx(a[n] * k, rel=1e-12, abs=1e-9)
        elif a[n] is not None:
            assert b[n] == pytest.approx(a[n], rel=1e-9)


def test_output_order_is_catalogue_order(spark, cat):
    names = ["LQ_01", "Financial_Aggregate_2", "DC_01"]
    df = compute_features(frame(spark, [{}]), cat, names)
    pos = {n: i for i, n in enumerate(cat.names)}
    assert df.columns[2:] == sorted(names, key=pos.get)


def test_skip_unavailable(spark, cat):
    df = frame(spark, [{}]).select("party_id", "data_date", "P_3", "A_1")
    out = compute_features(df, cat, skip_unavailable=True)
    assert "LQ_01" in out.columns          # A_1 / P_3
    assert "DC_01" not in out.columns      # needs G_692 ...


def test_registered_formula(spark, cat):
    from tallyframe.operators import formulas
    register_formula("MY_RATIO", lambda c, p: (c("A_1") - p("A_1"), c("P_3")))
    try:
        df = frame(spark, [{"A_1": 5.0, "P_3": 2.0, prev_name("A_1"): 1.0}], ["A_1"])
        assert df.select(formula_column("MY_RATIO").alias("x")).first()["x"] == 2.0
    finally:
        formulas._REGISTRY.pop("MY_RATIO")


def test_config_features(spark):
    feats = [ConfigFeature("g", numerator=("G_60",), neg_numerator=("G_60_1y",), denominator=("G_60_ly",)),
             ConfigFeature("s", numerator=("A_1", "A_2"), neg_numerator=("A_17",)),
             ConfigFeature("z", numerator=("A_1",), denominator=("P_3",))]
    df = frame(spark, [{"G_60": 12.0, prev_name("G_60"): 10.0, "A_1": 3.0, "P_3": 0.0},
                       {"G_60": 12.0}], ["G_60"])
    rows = sorted(config_features(df, feats).collect(), key=lambda r: r.party_id)
    assert rows[0]["g"] == pytest.approx(0.2) and rows[0]["s"] == 3.0 and rows[0]["z"] is None
    assert rows[1]["g"] is None and rows[1]["s"] == 0.0   # missing last year -> 0 denominator


def test_features_long(spark, cat):
    wide = compute_features(frame(spark, [{"A_1": 2.0, "P_3": 4.0}]), cat, ["LQ_01", "EF_03"])  # EF_03: G_62 is 0
    long = {r.feature: r.value for r in features_long(wide).collect()}
    assert long == {"LQ_01": 0.5, "EF_03": None}
    assert {r.feature for r in features_long(wide, drop_nulls=True).collect()} == {"LQ_01"}


def test_ratio_chain_plans_by_level(spark):
    from tallyframe.catalog import Catalog, Ratio
    chain = [Ratio("R0", "A", "B")] + [Ratio(f"R{i}", "A", f"R{i - 1}") for i in range(1, 11)]
    df = spark.createDataFrame([(1, 8.0, 2.0), (2, 8.0, 0.0)], "party_id long, A double, B double")
    out = compute_features(df, Catalog(chain), keys=["party_id"]).orderBy("party_id").collect()
    assert out[0]["R0"] == 4.0 and out[0]["R1"] == 2.0 and out[0]["R10"] == 4.0
    assert all(out[1][f.name] is None for f in chain)


def test_formula_inputs_need_no_declaration(spark):
    from tallyframe.catalog import Catalog, Custom
    from tallyframe.operators import formulas
    formulas.register_formula("X_ONE", lambda c, p: (c("A") + c("B") + c("C"), p("D")))
    formulas.register_formula("X_TWO", lambda c, p: (c("C") + c("B") + c("A"), p("D")))
    try:
        cat = Catalog([Custom("X_ONE", ()), Custom("X_TWO", ())])
        assert cat.accounts() == ["A", "B", "C", "D"] and cat.shifted_accounts() == ["D"]
        df = spark.createDataFrame([(1, 0.1, 0.2, 0.3, 1.0)], "party_id long, A double, B double, C double, D_prev double")
        row = compute_features(df, cat, keys=["party_id"], skip_unavailable=True).first()
        assert row.X_ONE == 0.1 + 0.2 + 0.3 and row.X_TWO == 0.3 + 0.2 + 0.1
        assert compute_features(df.drop("D_prev"), cat, keys=["party_id"], skip_unavailable=True).columns == ["party_id"]
    finally:
        formulas._REGISTRY.pop("X_ONE"), formulas._REGISTRY.pop("X_TWO")


def test_no_nan_in_output(spark, cat):
    df = frame(spark, [{}, {c: 0.0 for c in ACCOUNT_CODES}], cat.shifted_accounts())
    out = compute_features(df, cat)
    for r in out.collect():
        for v in r[2:]:
            assert v is None or not math.isnan(v)


def test_nan_input_is_missing_and_overflow_is_null(spark, cat):
    row = {c: 1.0 for c in ACCOUNT_CODES}
    row["P_3"] = float("nan")        # pandas-style missing value
    row["A_1"] = 1e308
    row["P_4"] = 1e-10
    df = frame(spark, [row])
    out = one(compute_features(df, cat, ["Financial_Aggregate_7", "LQ_01", "Financial_Aggregate_2", "DC_03"]))
    assert out["Financial_Aggregate_7"] == 0.0          # NaN read as missing -> 0
    assert out["LQ_01"] is None                         # A_1 / P_3 with P_3 missing -> 0 denominator
    assert out["Financial_Aggregate_2"] == 1e-10
    big = one(compute_features(frame(spark, [{"A_1": 1e308, "P_3": 1e-10}]), cat, ["LQ_01"]))
    assert big["LQ_01"] is None                         # overflow to inf -> null


def test_long_form_is_one_generator(spark):
    wide = spark.createDataFrame([(1, dt.date(2020, 12, 31), 1.5, None), (None, None, None, 0.0)], "party_id long, data_date date, a double, `b'c` double")
    out = features_long(wide)
    assert out.columns == ["party_id", "data_date", "feature", "value"]
    assert sorted(map(str, out.collect())) == sorted(map(str, wide.unpivot(["party_id", "data_date"], ["a", "b'c"], "feature", "value").collect()))
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
