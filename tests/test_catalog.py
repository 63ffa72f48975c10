"""Catalogue invariants (no Spark needed)."""

import pytest

from tallyframe.catalog import (
    Aggregate, Catalog, Ratio, config_columns, load_ratio_config, EXAMPLE_RATIO_CONFIG,
)
from tallyframe.operators.features import available_features
from tallyframe.operators.formulas import AMORT, formula_inputs, registered_formulas
from tallyframe.sources.schema import ACCOUNT_CODES, PHYSICAL_NAMES


@pytest.fixture(scope="module")
def cat():
    return Catalog.default()


def test_sizes(cat):
    assert len(cat) == 474
    assert len(set(cat.names)) == 474
    assert [len(cat.of_kind(k)) for k in ("aggregate", "ratio", "custom")] == [113, 320, 41]


def test_accounts(cat):
    assert cat.accounts() == sorted(ACCOUNT_CODES)
    assert len(cat.shifted_accounts()) == 27


def test_every_ratio_parent_is_an_earlier_aggregate(cat):
    seen = set()
    for f in cat:
        if isinstance(f, Ratio):
            for p in (f.numerator, f.denominator):
                assert p in seen and isinstance(cat[p], Aggregate)
        seen.add(f.name)


def test_custom_formulas_match_declared_inputs(cat):
    assert set(registered_formulas()) == {f.name for f in cat.of_kind("custom")}
    for f in cat.of_kind("custom"):
        cur, prev = formula_inputs(f.name)
        assert set(prev) == set(f.shifted), f.name
        expected = set(f.required) - ({AMORT} if f.name == "CONST_11" else set())
        assert set(cur) == expected, f.name


def test_only_mapped_codes_gives_199_features(cat):
    calculable, skipped = available_features(cat, PHYSICAL_NAMES.keys(), need_prev=False)
    kinds = [cat[n].kind for n in calculable]
    assert len(calculable) == 199
    assert (kinds.count("aggregate"), kinds.count("ratio"), kinds.count("custom")) == (59, 121, 19)
    assert len(skipped) == 474 - 199


def test_func_dialect():
    doc = {
        "S1": {"func": "calculate_financial_aggregate", "args": {"added_accounts": ["A", "B"],
                                                                  "subtracted_accounts": ["C"]}},
        "S2": {"func": "calculate_financial_aggregate", "args": {"added_accounts": ["D"]}},
        "R1": {"func": "calculate_financial_ratio",
               "args": {"numerator_column_name": "S1", "denominator_column_name": "S2"}},
        "R2": {"func": "calculate_financial_ratio",
               "args": {"numerator_column_name": "R1", "denominator_column_name": "RAW_X"}},
        "EF_17": {"func": "calculate_custom_financial_ratio",
                  "args": {"required_columns": ["A_15", "G_62"], "columns_to_shift": ["A_15"]}},
    }
    c = Catalog.from_func_dialect(doc)
    assert c.names == ["S1", "S2", "R1", "R2", "EF_17"]
    assert c.raw_dependencies("R2") == {"A", "B", "C", "D", "RAW_X"}
    assert c.closure(["R2"]) == ["S1", "S2", "R1", "R2"]
    assert c.shifted_dependencies("EF_17") == {"A_15"}


def test_cycle_rejected():
    with pytest.raises(ValueError, match="cycle"):
        Catalog([Ratio("X", "Y", "Z"), Ratio("Y", "X", "Z")])


def test_unknown_parent_in_closure():
    c = Catalog([Ratio("X", "NOPE", "NOPE2")])
    with pytest.raises(KeyError):
        c.closure(["X", "NOPE"])


def test_config_dialect_suffixes():
    feats = load_ratio_config({"features": {
        "g": {"numerator": ["G_60"], "neg_numerator": ["G_60_1y"], "denominator": ["G_60_ly"]},
        "n": {"numerator": ["A_1", "A_2"]},
    }})
    cur, last = config_columns(feats)
    assert cur == ["A_1", "A_2", "G_60"] and last == ["G_60"]
    assert feats[1].has_denominator is False
    assert len(load_ratio_config(EXAMPLE_RATIO_CONFIG)) >= 5
