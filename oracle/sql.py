"""DuckDB SQL for every registered query: fixture CTEs + the operator as plain SQL.

Written as text, independently of the Spark code: the catalogue is read with
``yaml`` directly and custom formulas come from :mod:`oracle.custom_sql`.
Sums keep the catalogue's operand order so doubles match bit for bit.
"""

from __future__ import annotations

import re
from functools import lru_cache
from pathlib import Path

import yaml

from oracle.custom_sql import CUSTOM_SQL

CATALOGUE = Path(__file__).resolve().parent.parent / "tallyframe" / "catalog" / "catalogue.yml"
RATIO_CONFIG = Path(__file__).resolve().parent.parent / "tallyframe" / "catalog" / "ratio_config.yml"

# Account codes.
CODES = sorted([
    "A_1", "A_10", "A_11", "A_12", "A_13", "A_131", "A_132", "A_15", "A_150", "A_151",
    "A_17", "A_2", "A_22", "A_23", "A_231", "A_232", "A_24", "A_25", "A_253", "A_258",
    "A_26", "A_29", "Amortisman_ve_Itfa_Giderleri", "G_60", "G_600", "G_601", "G_602",
    "G_610", "G_611", "G_612", "G_62", "G_63", "G_642", "G_646", "G_656", "G_66", "G_690",
    "G_691", "G_692", "P_3", "P_30", "P_300", "P_32", "P_331", "P_34", "P_340", "P_35",
    "P_4", "P_40", "P_400", "P_42", "P_43", "P_431", "P_440", "P_47", "P_472", "P_5",
])
# Physical names of 23 accounts.
MAPPED = {
    "P_30": "financial_liability_30", "P_40": "financial_liability_40", "A_10": "liquid_asset_10",
    "A_1": "revolving_asset_1", "A_2": "fixed_asset_2", "G_62": "sales_cost_62",
    "P_32": "commercial_liability_32", "P_42": "commercial_liability_42", "P_43": "other_liability_43",
    "P_3": "short_term_foreign_resource_3", "P_5": "equities_5", "P_4": "long_term_foreign_resource_4",
    "A_15": "inventory_15", "A_26": "nontangible_asset_26", "A_25": "tangible_asset_25",
    "G_66": "financial_expense_66", "A_12": "commercial_receivable_12", "A_22": "commercial_receivable_22",
    "P_35": "annual_construction_payment_35", "P_34": "advanced_received_34",
    "A_17": "annual_construction_cost_17", "G_60": "gross_sales_60", "A_11": "security_11",
}


def q(name: str) -> str:
    return f'"{name}"'


@lru_cache(maxsize=1)
def catalogue() -> dict:
    with open(CATALOGUE) as fh:
        return yaml.safe_load(fh)


def custom_inputs(name: str) -> tuple[list[str], list[str]]:
    num, den = CUSTOM_SQL[name]
    toks = re.findall(r"[A-Za-z_][A-Za-z_0-9]*", num + " " + den)
    cur = list(dict.fromkeys(t for t in toks if not t.endswith("_prev")))
    prev = list(dict.fromkeys(t[: -len("_prev")] for t in toks if t.endswith("_prev")))
    return cur, prev


def shifted_codes() -> list[str]:
    out = set()
    for _, (_, shift) in catalogue()["custom"].items():
        out.update(shift)
    return sorted(out)


# ---------------------------------------------------------------------------- fixtures
def _acct(i: int) -> str:
    return (f"case when (party_id*7 + yr*13 + {i}) % 11 = 0 then null "
            f"when (party_id + yr + {i}) % 17 = 0 then cast(0 as double) "
            f"else cast((s*{101 + 2 * i} + q*{31 * i}) % 1000003 as double) / 100 end")


def _codes(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{q(c)}" for c in CODES)


FIXTURES: dict[str, tuple[list[str], str]] = {}


def _fixture(name: str, deps: list[str], sql: str) -> None:
    FIXTURES[name] = (deps, sql)


_fixture("led", [], """select o_custkey as party_id, cast(year(o_orderdate) as bigint) as yr,
         sum(cast(round(l_extendedprice*100) as bigint)) as s_, sum(cast(l_quantity as bigint)) as q_
  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2""")
_fixture("led_b", ["led"], "select party_id, yr, cast(s_ as bigint) as s, cast(q_ as bigint) as q from led")
_fixture("statements", ["led_b"],
         "select party_id, make_date(cast(yr as int), 12, 31) as data_date, "
         + ", ".join(f"{_acct(i)} as {q(c)}" for i, c in enumerate(CODES, start=1)) + " from led_b")
_fixture("flagged", ["statements"], f"""select party_id, data_date, {_codes()}, 0 as prev_financial_indicator from statements
  union all
  select party_id, make_date(cast(year(data_date) + 1 as int), 12, 31) as data_date, {_codes()}, 1 as prev_financial_indicator
  from statements where party_id % 6 <> 0""")


def _raw_name(code: str) -> str:
    if code == "P_47":
        return None
    if code in MAPPED:
        return "_".join(w[:1].upper() + w[1:] for w in MAPPED[code].split("_"))
    return code.lower()


_raw_cols = []
for _c in sorted(CODES):
    if _c == "P_47":
        _raw_cols += [f"{q(_c)} as p_47_main", "cast(0 as double) as p_47_adj"]
    else:
        _raw_cols.append(f"{q(_c)} as {q(_raw_name(_c))}")
_fixture("raw_st", ["flagged"], f"""select party_id as "Party_Id",
    case when party_id % 3 = 0 then strftime(data_date, '%Y%m%d')
         when party_id % 3 = 1 then strftime(data_date, '%Y-%m-%d')
         else strftime(data_date, '%d.%m.%Y') end as "DATA_DATE",
    prev_financial_indicator as "Prev_Financial_Indicator", {", ".join(_raw_cols)}
  from flagged""")
_fixture("closing", ["flagged"], f"""select party_id, strftime(data_date, '%d.%m.%Y') as close_date,
    prev_financial_indicator, {_codes()} from flagged""")
_fixture("spine", ["statements"], """select party_id, data_date from statements where party_id % 4 <> 0
  union
  select party_id, make_date(cast(year(data_date) + 1 as int), 12, 31) as data_date
  from statements where party_id % 4 <> 0""")
_fixture("month_spine", ["statements"], """select party_id, cast(make_date(cast(year(data_date) + 1 as int), 1, 1) as varchar) as month_start from statements
  union all
  select party_id, cast(make_date(cast(year(data_date) + 1 as int), 6, 1) as varchar) as month_start from statements""")
_fixture("inflation", [], """select cast(ym as int) as year_month,
         case when idx % 23 = 0 then cast(0 as double) else 1 + cast(idx % 37 as double)/100 end as inflation_rate
  from (select distinct year(o_orderdate)*100+month(o_orderdate) as ym,
                        year(o_orderdate)*12+month(o_orderdate) as idx from orders) m
  where idx % 19 <> 0""")
_fixture("inflation_m", ["inflation"],
         "select year_month, max(inflation_rate) as inflation_rate from inflation group by year_month")
_fixture("sparse", [], """select party_id, data_date,
       case when (party_id + cnt) % 3 = 0 then null else cents end as amount_cents,
       case when party_id % 5 = 0 then null else cnt end as n_orders
  from (select o_custkey as party_id, cast(max(o_orderdate) as date) as data_date,
               cast(sum(cast(round(o_totalprice*100) as bigint)) as bigint) as cents, count(*) as cnt
        from orders group by o_custkey, year(o_orderdate), month(o_orderdate)) t""")
_fixture("model_t", ["statements"], 'select party_id, data_date, "A_15" as feature_x from statements')
_fixture("source_t", ["flagged"], """select party_id, data_date, "A_17" as raw_feature from flagged
  where prev_financial_indicator = 1 and party_id % 5 <> 0""")
_fixture("paired", ["flagged"], lambda: _paired_sql("flagged"))


def _paired_sql(src: str, cur_codes=None, shift=None) -> str:
    cur_codes = CODES if cur_codes is None else cur_codes
    shift = shifted_codes() if shift is None else shift
    prev = ", ".join(f"p.{q(c)} as {q(c + '_prev')}" for c in shift)
    return (f"select c.party_id, c.data_date, {', '.join('c.' + q(x) for x in cur_codes)}"
            + (f", {prev}" if prev else "")
            + f" from (select * from {src} where prev_financial_indicator = 0) c"
            f" left join (select * from {src} where prev_financial_indicator = 1) p"
            f" on c.party_id = p.party_id and c.data_date = p.data_date")


def _panel_sql(src: str, cols: list[str]) -> str:
    return f"""select g.party_id, g.data_date, {", ".join("s." + q(c) for c in cols)}
  from (select p.party_id, make_date(cast(y as int), 12, 31) as data_date
        from (select distinct party_id from {src}) p,
             (select unnest(generate_series(year(min(data_date)), year(max(data_date)))) as y,
                     min(data_date) as lo, max(data_date) as hi from {src}) b
        where make_date(cast(y as int), 12, 31) between b.lo and b.hi) g
  left join (select * from {src} where month(data_date) = 12 and day(data_date) = 31) s
    on g.party_id = s.party_id and g.data_date = s.data_date"""


_fixture("panel", ["statements"], lambda: _panel_sql("statements", CODES))
_fixture("lagged", ["panel"], lambda: "select *, " + ", ".join(
    f"lag({q(c)}) over (partition by party_id order by data_date) as {q(c + '_prev')}" for c in shifted_codes())
    + " from panel")


def with_fixtures(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        sql = FIXTURES[n][1]
        parts.append(f"{n} as ({sql() if callable(sql) else sql})")
    return "with " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------------------- features
def agg_sql(added: list[str], subtracted: list[str]) -> str:
    pos = " + ".join(f"coalesce({q(a)}, cast(0 as double))" for a in added)
    if not subtracted:
        return f"({pos})" if pos else "cast(0 as double)"
    neg = " + ".join(f"coalesce({q(a)}, cast(0 as double))" for a in subtracted)
    return f"(({pos}) - ({neg}))" if pos else f"(cast(0 as double) - ({neg}))"


def div_sql(num: str, den: str) -> str:
    return (f"case when ({den}) is null or ({den}) = 0 then null "
            f"when isinf(({num}) / ({den})) then null else ({num}) / ({den}) end")


def _quote_idents(expr: str) -> str:
    return re.sub(r"\b([A-Za-z_][A-Za-z_0-9]*)\b", lambda m: q(m.group(1)), expr)


def feature_sql(name: str, agg_ref: bool = True) -> str:
    cat = catalogue()
    if name in cat["aggregates"]:
        return q(name) if agg_ref else agg_sql(*cat["aggregates"][name])
    if name in cat["ratios"]:
        num, den = cat["ratios"][name]
        return div_sql(feature_sql(num), feature_sql(den))
    num, den = CUSTOM_SQL[name]
    return div_sql(_quote_idents(num), _quote_idents(den))


def features_sql(base: str, names: list[str], keys: str = "party_id, data_date") -> str:
    """Two levels: aggregates as columns of a sub-select, then every feature."""
    cat = catalogue()
    need = set()
    for n in names:
        if n in cat["aggregates"]:
            need.add(n)
        elif n in cat["ratios"]:
            need.update(cat["ratios"][n])
    aggs = [a for a in cat["aggregates"] if a in need]
    inner = f"select *, {', '.join(agg_sql(*cat['aggregates'][a]) + ' as ' + q(a) for a in aggs)} from {base}" \
        if aggs else f"select * from {base}"
    outer = ", ".join(f"cast({feature_sql(n)} as double) as {q(n)}" for n in names)
    return f"select {keys}, {outer} from ({inner}) t"


def names_of(kind: str, prefix: str = "") -> list[str]:
    section = {"aggregate": "aggregates", "ratio": "ratios", "custom": "custom"}[kind]
    return [n for n in catalogue()[section] if n.startswith(prefix)]


def all_names() -> list[str]:
    cat = catalogue()
    return [*cat["aggregates"], *cat["ratios"], *cat["custom"]]
