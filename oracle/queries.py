"""One DuckDB SQL text per registered query (same names, same output column names)."""

from __future__ import annotations

import yaml

from oracle.sql import (
    CODES, MAPPED, RATIO_CONFIG, all_names, catalogue, custom_inputs, div_sql, features_sql, names_of, q,
    shifted_codes, with_fixtures,
)

WINDOW_MIN, WINDOW_MAX = "1999-06-15", "2001-03-31"
AUDIT_MONTH = ("2000-12-01", "2001-01-01")
SPARSE_MONTH = ("1999-06-01", "1999-07-01")

PARSE = ("coalesce(try_strptime({c}, '%Y%m%d'), try_strptime({c}, '%Y-%m-%d'), "
         "try_strptime({c}, '%d.%m.%Y'))::date")


def _raw_phys(code: str) -> str:
    if code == "P_47":
        return "(cast(p_47_main as double) + cast(p_47_adj as double))"
    name = MAPPED.get(code, code)
    return f"cast({q(name)} as double)"


def _mapped_select() -> str:
    return (f"select cast(\"Party_Id\" as bigint) as party_id, {PARSE.format(c='\"DATA_DATE\"')} as data_date, "
            f"cast(\"Prev_Financial_Indicator\" as int) as prev_financial_indicator, "
            + ", ".join(f"{_raw_phys(c)} as {q(c)}" for c in CODES) + " from raw_st")


def _scale(cols: list[str], mode: str, src: str = "b") -> str:
    out = []
    for c in cols:
        x = f"{src}.{q(c)}"
        if mode == "multiply":
            out.append(f"{x} * i.inflation_rate as {q(c)}")
        else:
            out.append(f"case when i.inflation_rate is null or i.inflation_rate = 0 then {x} "
                       f"else {x} / i.inflation_rate end as {q(c)}")
    return ", ".join(out)


def _normalized(src: str, cols: list[str], mode: str) -> str:
    lag = "b.data_date - interval 1 month" if mode == "multiply" else "b.data_date"
    return (f"select b.party_id, b.data_date, {_scale(cols, mode)} from {src} b "
            f"left join inflation_m i on i.year_month = year({lag})*100 + month({lag})")


def _semi_spine(src: str) -> str:
    return (f"select * from {src} x where exists (select 1 from spine s "
            f"where s.party_id = x.party_id and s.data_date = x.data_date)")


def _pair(src: str, cur: list[str], shift: list[str]) -> str:
    prev = "".join(f", p.{q(c)} as {q(c + '_prev')}" for c in shift)
    return (f"select c.party_id, c.data_date, {', '.join('c.' + q(x) for x in cur)}{prev}"
            f" from (select * from {src} where prev_financial_indicator = 0) c"
            f" left join (select * from {src} where prev_financial_indicator = 1) p"
            f" on c.party_id = p.party_id and c.data_date = p.data_date")


def _signed(added, subtracted) -> str:
    def side(cols):
        return " + ".join(f"coalesce({q(_cfg_col(c))}, cast(0 as double))" for c in cols)
    pos, neg = side(added), side(subtracted)
    if pos and neg:
        return f"(({pos}) - ({neg}))"
    if pos:
        return f"({pos})"
    return f"(cast(0 as double) - ({neg}))" if neg else "cast(0 as double)"


def _cfg_col(c: str) -> str:
    return c[:-3] + "_prev" if c.endswith(("_1y", "_ly")) else c


def _config() -> dict:
    with open(RATIO_CONFIG) as fh:
        return yaml.safe_load(fh)["features"]


def config_features_sql() -> str:
    cfg = _config()
    cols = set()
    for spec in cfg.values():
        for k in ("numerator", "neg_numerator", "denominator", "neg_denominator"):
            cols.update(spec.get(k) or [])
    current = sorted(c for c in cols if not c.endswith(("_1y", "_ly")))
    last = sorted({c[:-3] for c in cols if c.endswith(("_1y", "_ly"))})
    select_cols = list(dict.fromkeys(current + last))
    exprs = []
    for name, spec in cfg.items():
        num = _signed(spec.get("numerator") or [], spec.get("neg_numerator") or [])
        if spec.get("denominator") or spec.get("neg_denominator"):
            den = _signed(spec.get("denominator") or [], spec.get("neg_denominator") or [])
            exprs.append(f"case when {den} = 0 then null else {num} / {den} end as {q(name)}")
        else:
            exprs.append(f"{num} as {q(name)}")
    amounts = current + [c + "_prev" for c in last]
    return (with_fixtures("closing", "spine", "inflation_m")
            + f", c0 as (select party_id, try_strptime(close_date, '%d.%m.%Y')::date as data_date, "
              f"prev_financial_indicator, {', '.join(q(c) for c in select_cols)} from closing)"
            + f", c1 as ({_semi_spine('c0')})"
            + f", pr as ({_pair('c1', current, last)})"
            + f", nm as ({_normalized('pr', amounts, 'multiply')})"
            + f", ft as (select party_id, data_date, {', '.join(exprs)} from nm)"
            + " select s.party_id, s.data_date, " + ", ".join(f"ft.{q(n)}" for n in cfg)
            + " from (select distinct party_id, data_date from spine) s left join ft"
              " on s.party_id = ft.party_id and s.data_date = ft.data_date")


def _deps(name: str) -> set[str]:
    cat = catalogue()
    if name in cat["aggregates"]:
        a, s = cat["aggregates"][name]
        return set(a or []) | set(s or [])
    if name in cat["custom"]:
        cur, prev = custom_inputs(name)  # the formula's own inputs; last year's as columns
        return set(cur) | {p + "_prev" for p in prev}
    out = set()
    for parent in cat["ratios"][name]:
        out |= _deps(parent) if (parent in cat["aggregates"] or parent in cat["ratios"]
                                 or parent in cat["custom"]) else {parent}
    return out


def coverage_report_sql(paired: bool = True) -> str:
    cat = catalogue()
    avail = sorted(MAPPED) if paired else CODES
    shift = [c for c in shifted_codes() if c in avail] if paired else []
    kinds = {**{n: "aggregate" for n in cat["aggregates"]}, **{n: "ratio" for n in cat["ratios"]},
             **{n: "custom" for n in cat["custom"]}}
    counts, rows = [], []
    for i, n in enumerate(all_names()):
        missing = sorted(_deps(n) - set(avail) - {c + "_prev" for c in shift})
        if missing:
            count = "cast(null as bigint)"
        else:
            inputs = sorted(_deps(n))
            counts.append(f"count(*) filter (where {' and '.join(q(c) + ' is not null' for c in inputs)}) as c{i}")
            count = f"cnt.c{i}"
        rows.append(f"select {i + 1} as position, '{n}' as feature, '{kinds[n]}' as kind, "
                    f"'{'skipped' if missing else 'calculable'}' as status, "
                    f"'{','.join(missing)}' as missing_accounts, {count} as complete_rows from cnt")
    return (with_fixtures("flagged" if paired else "statements")
            + (f", pm as ({_pair('flagged', avail, shift)})" if paired else ", pm as (select * from statements)")
            + f", cnt as (select {', '.join(counts)} from pm)\n"
            + "\nunion all\n".join(rows))


def _null_audit(model: str, source: str) -> str:
    return ("select 'feature_x' as model_column, 'raw_feature' as source_column, "
            "count(*) filter (where m.feature_x is null) as model_nulls, "
            "count(*) filter (where s.raw_feature is null) as source_nulls, "
            "count(*) filter (where m.feature_x is null and s.raw_feature is null) as both_null "
            f"from {model} m full outer join {source} s on m.party_id = s.party_id and m.data_date = s.data_date")


def _month(src: str, bounds: tuple[str, str]) -> str:
    return f"(select * from {src} where data_date >= date '{bounds[0]}' and data_date < date '{bounds[1]}')"


def build() -> dict[str, str]:
    shift = shifted_codes()
    all_feats = all_names()
    out: dict[str, str] = {}
    out["scan_statements_window"] = (
        with_fixtures("sparse")
        + f"select * from sparse where data_date >= date '{WINDOW_MIN}' - interval 29 month "
          f"and data_date <= date '{WINDOW_MAX}' and month(data_date) = 12")
    out["map_columns"] = with_fixtures("raw_st") + _mapped_select()
    out["parse_dates"] = (with_fixtures("raw_st")
                          + "select cast(\"Party_Id\" as bigint) as party_id, "
                            "\"Prev_Financial_Indicator\" as prev_financial_indicator, "
                            "\"DATA_DATE\" as date_text, " + PARSE.format(c='"DATA_DATE"') + " as data_date from raw_st")
    out["restrict_to_spine"] = (
        with_fixtures("closing", "spine")
        + f", c0 as (select party_id, try_strptime(close_date, '%d.%m.%Y')::date as data_date, "
          f"prev_financial_indicator, {', '.join(q(c) for c in CODES)} from closing) "
        + _semi_spine("c0"))
    out["year_grid"] = with_fixtures("panel") + "select * from panel"
    out["pair_prev_flag"] = with_fixtures("paired") + "select * from paired"
    out["pair_prev_lag"] = with_fixtures("lagged") + "select * from lagged"
    out["normalize_multiply"] = with_fixtures("statements", "inflation_m") + _normalized("statements", CODES, "multiply")
    out["normalize_divide"] = with_fixtures("statements", "inflation_m") + _normalized("statements", CODES, "divide")
    out["agg_features"] = with_fixtures("statements") + features_sql("statements", names_of("aggregate"))
    for key, prefix in (("ratio_dc", "DC_"), ("ratio_fs", "FS_"), ("ratio_lq", "LQ_"),
                        ("ratio_prof", "PROF_"), ("ratio_ef", "EF_"), ("ratio_const", "CONST_")):
        out[key] = with_fixtures("statements") + features_sql("statements", names_of("ratio", prefix))
    out["custom_flag"] = with_fixtures("paired") + features_sql("paired", names_of("custom"))
    out["custom_lag"] = with_fixtures("lagged") + features_sql("lagged", names_of("custom"))
    out["config_features"] = config_features_sql()
    out["attach_to_spine"] = (
        with_fixtures("paired", "spine")
        + f", lq as ({features_sql('paired', all_feats)}) "
        + "select s.party_id, s.data_date, " + ", ".join(f"lq.{q(n)}" for n in all_feats)
        + " from (select distinct party_id, data_date from spine) s left join lq "
          "on s.party_id = lq.party_id and s.data_date = lq.data_date")
    out["attach_prev_month_end"] = (
        with_fixtures("statements", "month_spine")
        + "select m.party_id, m.month_start, cast(cast(m.month_start as date) - 1 as date) as prev_month_end, "
        + ", ".join(f"s.{q(c)}" for c in CODES)
        + " from month_spine m left join statements s on cast(m.party_id as decimal(16,0)) = "
          "cast(s.party_id as decimal(16,0)) and s.data_date = cast(m.month_start as date) - 1")
    out["month_grid"] = (
        with_fixtures("sparse")
        + "select party_id, cast(unnest(generate_series(min(date_trunc('month', data_date)), "
          "max(date_trunc('month', data_date)) + interval 12 month, interval 1 month)) as date) as data_date "
          "from sparse group by party_id")
    out["forward_fill"] = (
        with_fixtures("sparse")
        + """, d as (select *, cast(date_trunc('month', data_date) as date) as month_date from sparse),
g as (select party_id, cast(unnest(generate_series(min(month_date), max(month_date) + interval 12 month,
             interval 1 month)) as date) as month_date from d group by party_id),
j as (select g.party_id, g.month_date, amount_cents, n_orders from g left join d using (party_id, month_date))
select party_id, month_date as data_date,
       last_value(amount_cents ignore nulls) over w as amount_cents,
       last_value(n_orders ignore nulls) over w as n_orders
from j window w as (partition by party_id order by month_date rows between 12 preceding and current row)""")
    out["null_audit"] = with_fixtures("model_t", "source_t") + _null_audit("model_t", "source_t")
    out["null_audit_month"] = (with_fixtures("model_t", "source_t")
                               + _null_audit(_month("model_t", AUDIT_MONTH), _month("source_t", AUDIT_MONTH)))
    out["filter_month"] = with_fixtures("sparse") + "select * from " + _month("sparse", SPARSE_MONTH) + " x"
    out["coverage_report"] = coverage_report_sql()
    out["compute_features"] = (
        with_fixtures("raw_st", "inflation_m")
        + f", mp as ({_mapped_select()})"
        + f", pr as ({_pair('mp', CODES, shift)})"
        + f", nm as ({_normalized('pr', CODES + [c + '_prev' for c in shift], 'divide')}) "
        + features_sql("nm", all_feats))
    out["features_long"] = (
        with_fixtures("paired")
        + f", ft as ({features_sql('paired', all_feats)}) "
        + "select party_id, data_date, feature, value from ft unpivot include nulls (value for feature in ("
        + ", ".join(q(n) for n in all_feats) + ")) u")
    out["panel_features"] = with_fixtures("lagged") + features_sql("lagged", all_feats)
    out["stage_panel"] = with_fixtures("panel") + "select * from panel"
    out["coverage_report_unpaired"] = coverage_report_sql(paired=False)
    out["null_audit_all"] = (
        with_fixtures("statements", "flagged")
        + ", src as (select * from flagged where prev_financial_indicator = 1 and party_id % 5 <> 0)"
        + ", c as (select " + ", ".join(
            f"count(*) filter (where m.{q(c)} is null) as m{i}, count(*) filter (where s.{q(c)} is null) as s{i}, "
            f"count(*) filter (where m.{q(c)} is null and s.{q(c)} is null) as b{i}" for i, c in enumerate(CODES))
        + " from statements m full outer join src s on m.party_id = s.party_id and m.data_date = s.data_date) "
        + " union all ".join(f"select '{c}' as model_column, '{c}' as source_column, m{i} as model_nulls, "
                             f"s{i} as source_nulls, b{i} as both_null from c" for i, c in enumerate(CODES)))
    out["yearly_job"] = (
        with_fixtures("statements", "inflation_m")
        + ", w as (select * from statements where data_date between date '1997-01-15' and date '2001-03-31' "
          "and month(data_date) = 12)"
        + f", nm as ({_normalized('w', CODES, 'divide')})"
        + ", g as (select party_id, make_date(cast(y as int), 12, 31) as data_date from "
          "(select distinct party_id from w) p, (select unnest(generate_series(1997, 2000)) as y) b)"
        + ", pn as (select g.party_id, g.data_date, " + ", ".join(f"nm.{q(c)}" for c in CODES)
        + " from g left join nm on g.party_id = nm.party_id and g.data_date = nm.data_date)"
        + ", lg as (select *, " + ", ".join(
            f"lag({q(c)}) over (partition by party_id order by data_date) as {q(c + '_prev')}" for c in shift)
        + " from pn) " + features_sql("lg", all_feats))
    out["write_table"] = out["agg_features"]
    # Dirty inputs: duplicates, null and malformed keys, bad rates.
    out["pair_prev_flag_dirty"] = (
        with_fixtures("flagged")
        + """, d as (
  select party_id, case when party_id % 7 = 0 then null else data_date end as data_date, prev_financial_indicator, "A_1", "P_3" from flagged
  union all
  select party_id, data_date, prev_financial_indicator, "A_1" + 1, "P_3" from flagged where party_id % 5 = 0),
o as (select *, row_number() over (partition by party_id, data_date, prev_financial_indicator
        order by "A_1" desc nulls last, "P_3" desc nulls last) as r1,
      row_number() over (partition by party_id, data_date, prev_financial_indicator order by "A_1" desc nulls last) as r2 from d)
select c.party_id, c.data_date, c."A_1", c."P_3", p."A_1" as "A_1_prev"
from (select * from o where r1 = 1 and prev_financial_indicator = 0) c
left join (select * from o where r2 = 1 and prev_financial_indicator = 1) p
  on c.party_id = p.party_id and c.data_date = p.data_date""")
    out["forward_fill_dup"] = (
        with_fixtures("sparse")
        + """, d0 as (select * from sparse
  union all select party_id, cast(date_trunc('month', data_date) as date), amount_cents + 100, n_orders from sparse where party_id % 3 = 0
  union all select null, data_date, amount_cents, n_orders from sparse where party_id % 11 = 0),
d as (select party_id, cast(date_trunc('month', data_date) as date) as month_date,
             max(amount_cents) as amount_cents, max(n_orders) as n_orders from d0 group by 1, 2),
g as (select party_id, cast(unnest(generate_series(min(month_date), max(month_date) + interval 12 month,
             interval 1 month)) as date) as month_date from d group by party_id),
j as (select g.party_id, g.month_date, amount_cents, n_orders from g
      left join d on g.party_id = d.party_id and g.month_date = d.month_date)
select party_id, month_date as data_date,
       last_value(amount_cents ignore nulls) over w as amount_cents,
       last_value(n_orders ignore nulls) over w as n_orders
from j window w as (partition by party_id order by month_date rows between 12 preceding and current row)""")
    out["map_columns_dirty"] = (
        with_fixtures("raw_st")
        + """, rd as (select * replace (
   case when "Party_Id" % 10 = 3 then "Party_Id" || 'x' when "Party_Id" % 10 = 4 then null else "Party_Id"::varchar end as "Party_Id",
   case when "Party_Id" % 4 = 1 then 'bad' else "DATA_DATE" end as "DATA_DATE",
   case when "Party_Id" % 9 = 2 then 'n/a' else "Prev_Financial_Indicator"::varchar end as "Prev_Financial_Indicator") from raw_st) """
        + _mapped_select().replace("cast(\"Party_Id\"", "try_cast(\"Party_Id\"").replace(
            "cast(\"Prev_Financial_Indicator\"", "try_cast(\"Prev_Financial_Indicator\"").replace("from raw_st", "from rd"))
    dirty_index = (", inflation_d as (select year_month, case when year_month % 7 = 0 then null else inflation_rate end "
                   "as inflation_rate from inflation_m)")
    out["normalize_divide_dirty"] = (with_fixtures("statements", "inflation_m") + dirty_index + " "
                                     + _normalized("statements", CODES, "divide").replace("join inflation_m", "join inflation_d"))
    out["attach_prev_month_end_dirty"] = (
        with_fixtures("statements", "month_spine")
        + """, md as (select case when party_id % 10 = 3 then party_id || 'x'
   when party_id % 10 = 4 then '1234567890' || lpad(party_id::varchar, 7, '0') else party_id::varchar end as party_id, month_start from month_spine) """
        + "select m.party_id, m.month_start, cast(cast(m.month_start as date) - 1 as date) as prev_month_end, "
        + ", ".join(f"s.{q(c)}" for c in CODES)
        + " from md m left join statements s on try_cast(m.party_id as decimal(16,0)) = "
          "cast(s.party_id as decimal(16,0)) and s.data_date = cast(m.month_start as date) - 1")
    out["read_statements"] = (
        with_fixtures("flagged")
        + "select party_id, data_date, prev_financial_indicator, "
        + ", ".join(q(c) for c in sorted(MAPPED)) + " from flagged where prev_financial_indicator in (0, 1)")
    out["write_features"] = out["agg_features"]
    out["flagship"] = (
        with_fixtures("flagged", "spine", "inflation_m")
        + f", f1 as ({_semi_spine('flagged')})"
        + f", pr as ({_pair('f1', CODES, shift)})"
        + f", nm as ({_normalized('pr', CODES + [c + '_prev' for c in shift], 'divide')})"
        + f", ft as ({features_sql('nm', all_feats)}) "
        + "select s.party_id, s.data_date, " + ", ".join(f"ft.{q(n)}" for n in all_feats)
        + " from (select distinct party_id, data_date from spine) s left join ft "
          "on s.party_id = ft.party_id and s.data_date = ft.data_date")
    # Other ways to a result that is above.
    for name, same in (("restrict_to_spine_filtered", "restrict_to_spine"), ("flagship_filtered", "flagship"),
                       ("publish_features", "agg_features"), ("publish_table", "agg_features"), ("stage_reuse", "stage_panel"),
                       ("scan_clustered", "scan_statements_window"), ("pair_prev_stream", "pair_prev_flag")):
        out[name] = out[same]
    out["upsert_statements"] = (
        with_fixtures("flagged")
        + "select * exclude (prev_financial_indicator, newest) from (select *, row_number() over (partition by party_id, data_date order by "
          "case when prev_financial_indicator = 0 then 1 when party_id % 3 = 0 then 3 else 2 end desc) as newest from flagged) where newest = 1")
    out["normalize_base_month"] = (
        with_fixtures("statements", "inflation_m")
        + ", base as (select max(inflation_rate) as at_base from inflation_m where year_month = 199506) "
        + "select b.party_id, b.data_date, " + ", ".join(
            f"case when i.inflation_rate is null or i.inflation_rate = 0 or base.at_base is null or base.at_base = 0 then b.{q(c)} "
            f"else b.{q(c)} * (base.at_base / i.inflation_rate) end as {q(c)}" for c in CODES)
        + " from statements b left join inflation_m i on i.year_month = year(b.data_date) * 100 + month(b.data_date), base")
    first, second, third = [*names_of("ratio", "LQ_")[:2], names_of("ratio", "DC_")[0]]
    above = div_sql(q(first), q(third))
    out["extended_catalogue"] = (
        with_fixtures("flagged")
        + f", pr as ({_pair('flagged', CODES, ['A_1'])})"
        + f", ft as ({features_sql('pr', [first, second, third])})"
        + f', tw as (select *, {above} as "RATIO_OF_RATIOS" from ft)'
        + f', th as (select *, {div_sql(q("RATIO_OF_RATIOS"), q(second))} as "RATIO_ABOVE" from tw)'
        + f' select th.party_id, th.data_date, "RATIO_OF_RATIOS", "RATIO_ABOVE", {div_sql("(pr." + q("A_1") + " - pr." + q("A_1_prev") + ")", "pr." + q("P_3"))}'
          ' as "GROWTH_OF_A_1" from th join pr on th.party_id = pr.party_id and th.data_date = pr.data_date')
    out["forward_fill_carry"] = out["forward_fill"]
    out["forward_fill_carry_long"] = out["forward_fill_dup"].replace("rows between 12 preceding", "rows between 30 preceding")
    dirty = ("rd as (select * replace (case when \"Party_Id\" % 10 = 3 then \"Party_Id\" || 'x' when \"Party_Id\" % 10 = 4 then null "
             "else \"Party_Id\"::varchar end as \"Party_Id\", case when \"Party_Id\" % 4 = 1 then 'bad' else \"DATA_DATE\" end as \"DATA_DATE\", "
             "case when \"Party_Id\" % 9 = 2 then 'n/a' else \"Prev_Financial_Indicator\"::varchar end as \"Prev_Financial_Indicator\") from raw_st)")
    bad = ("concat_ws(',', case when \"Party_Id\" like '%x' then 'party_id' end, case when \"DATA_DATE\" = 'bad' then 'data_date' end, "
           "case when \"Prev_Financial_Indicator\" = 'n/a' then 'prev_financial_indicator' end)")
    out["quarantine_rows"] = (
        with_fixtures("raw_st") + f", {dirty}, b as (select {bad} as malformed, * from rd) "
        + 'select malformed, "Party_Id", "DATA_DATE", "Prev_Financial_Indicator" from b where malformed <> \'\'')
    out["quarantine_accepted"] = (
        with_fixtures("raw_st") + f", {dirty}, ok as (select * from rd where {bad} = '') " + _mapped_select().replace("from raw_st", "from ok"))
    twice = ", ".join(f"case when party_id % 5 = 0 then {q(c)} * 2 else {q(c)} end as {q(c)}" for c in ("A_15", "P_3"))
    out["restate_features"] = (
        with_fixtures("paired") + f", rs as (select * replace ({twice}) from paired) " + features_sql("rs", all_feats))
    return out
