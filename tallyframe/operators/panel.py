"""Panels: pair each statement with last year's, build dense grids, forward fill.

Shuffle budget (each ``Exchange`` in the physical plan):

* :func:`pair_prev` (flag strategy) - one hash exchange on (party, date) with a
  map-side partial aggregate, so duplicate keys are collapsed before they move;
* :func:`year_panel`, :func:`pair_prev_lag` - one hash exchange on the party with a map-side
  partial aggregate that holds a column a year, so the input is read once, full rows
  move once, and grid and previous year need neither join nor window;
* :func:`forward_fill` - one row per (party, month) (partial aggregate), then one
  exchange on party that serves the month steps and the blocked fill windows;
  each block carries a 12-month halo of the previous block's observations.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalar import month_from_index, month_index
from tallyframe.functions.sqltext import ident, struct_of
from tallyframe.operators.formulas import prev_name
from tallyframe.sources.schema import DATE, FLAG, KEYS

_CUR, _PREV = "__cur", "__prev"


def _values(cols: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(cols))


def pair_prev(df: DataFrame, shift_cols: Sequence[str], cur_cols: Sequence[str] | None = None,
              keys: Sequence[str] = KEYS, flag_col: str = FLAG) -> DataFrame:
    """Current statement (flag 0) with last year's figures (flag 1) of the same filing.

    Output: keys, ``cur_cols`` and ``<c>_prev`` for each of ``shift_cols``; one row
    per key that has a flag-0 row (keys with only a flag-1 row are dropped,
    missing flag-1 gives null ``_prev`` values).

    One grouped aggregation replaces two de-duplications and a self join.  When
    a key holds several rows of the same flag the row with the largest values
    (struct order, field by field) is kept, so the pick is deterministic.  A null
    key matches nothing: such rows keep one row per key with null ``_prev`` values.
    """
    cur_cols = [c for c in df.columns if c not in (*keys, flag_col)] if cur_cols is None else cur_cols
    cur_cols, shift_cols = _values(cur_cols), _values(shift_cols)
    flag = ident(flag_col)
    known = " AND ".join(f"{ident(k)} IS NOT NULL" for k in keys)
    aggs = [F.expr(f"max(CASE WHEN {flag} = 0 THEN {struct_of(cur_cols)} END)").alias(_CUR)]
    if shift_cols:
        aggs.append(F.expr(f"max(CASE WHEN {flag} = 1 AND {known} THEN {struct_of(shift_cols)} END)").alias(_PREV))
    paired = (df.where(F.col(flag_col).isin(0, 1)).groupBy(*keys).agg(*aggs)
                .where(F.col(_CUR).isNotNull()))
    out = [ident(k) for k in keys] + [f"{_CUR}.{ident(c)} AS {ident(c)}" for c in cur_cols]
    out += [f"{_PREV}.{ident(c)} AS {ident(prev_name(c))}" for c in shift_cols]
    return paired.selectExpr(*out)


def dedupe_latest(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key; among duplicates the largest row (struct order) wins."""
    vals = [c for c in df.columns if c not in keys]
    if not vals:
        return df.dropDuplicates(list(keys))
    return (df.groupBy(*keys).agg(F.expr(f"max({struct_of(vals)})").alias(_CUR))
              .selectExpr(*[ident(k) for k in keys], *[f"{_CUR}.{ident(c)} AS {ident(c)}" for c in vals]))


def date_bounds(df: DataFrame, date_col: str = DATE) -> tuple:
    """Global (min, max) of a date column: one small aggregate job, two scalars to the driver."""
    row = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    return row["lo"], row["hi"]


def year_grid(df: DataFrame, keys: Sequence[str] = KEYS, bounds: tuple | None = None) -> DataFrame:
    """Dense (party, 31 December) grid for every party, between the global min and max date.

    Only year ends inside [min, max] are kept; the bounds come from all rows,
    the parties from all rows (also those with only off-December statements).
    """
    party, date = keys
    lo, hi = bounds or date_bounds(df, date)
    if lo is None:
        return df.select(party, date).limit(0)
    years = F.sequence(F.lit(lo.year), F.lit(hi.year))
    year_end = F.make_date(F.col("__y"), F.lit(12), F.lit(31))
    return (df.select(party).distinct()
              .select(party, F.explode(years).alias("__y"))
              .select(party, year_end.alias(date))
              .where(F.col(date).between(F.lit(lo), F.lit(hi))))


def _grid_years(bounds: tuple) -> list[int]:
    """Years whose 31 December lies within the bounds."""
    lo, hi = (d.date() if isinstance(d, dt.datetime) else d for d in bounds)
    return [y for y in range(lo.year, hi.year + 1) if lo <= dt.date(y, 12, 31) <= hi]


def _year_rows(df: DataFrame, value_cols: Sequence[str], keys: Sequence[str], bounds: tuple, out: Sequence[str],
               with_last: bool) -> DataFrame:
    """One row per party and year end of the grid: ``out`` reads ``cur`` (that year's accounts) and, ``with_last``, ``last``.

    One grouped aggregate on the party: a column for every year of the grid holds that year's statement, the largest row
    of several.  Its map-side partial collapses repeated statements and brings a party's years together, so full rows move
    once, and the grid, the fill of missing years and last year's figures are read off the columns.
    """
    party, date = keys
    years = _grid_years(bounds)
    row, p, d = struct_of(value_cols), ident(party), ident(date)
    by_year = df.groupBy(F.col(p)).agg(*(
        F.expr(f"max(CASE WHEN {d} = DATE'{y:04d}-12-31' AND {p} IS NOT NULL THEN {row} END)").alias(f"y{y}") for y in years))
    cells = []
    for k, y in enumerate(years):
        last = f", {f'y{years[k - 1]}' if k else f'CAST(NULL AS {_struct_type(df, value_cols)})'} AS last" if with_last else ""
        cells.append(f"struct(DATE'{y:04d}-12-31' AS day, y{y} AS cur{last})")
    rows = by_year.selectExpr(p, f"explode(array({', '.join(cells)})) AS cell")
    return rows.selectExpr(p, f"cell.day AS {d}", *out)


def year_panel(df: DataFrame, value_cols: Sequence[str] | None = None, keys: Sequence[str] = KEYS,
               bounds: tuple | None = None) -> DataFrame:
    """Grid left-joined with the 31 December statements (duplicates picked deterministically).

    Every party of ``df`` has every year end between the bounds, with null accounts where it has no statement.
    """
    value_cols = [c for c in df.columns if c not in keys] if value_cols is None else list(value_cols)
    bounds = bounds or date_bounds(df, keys[1])
    if bounds[0] is None or not _grid_years(bounds):
        return df.select(*keys, *value_cols).limit(0)
    return _year_rows(df, value_cols, keys, bounds, [f"cell.cur.{ident(c)} AS {ident(c)}" for c in value_cols], False)


def _struct_type(df: DataFrame, cols: Sequence[str]) -> str:
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return "struct<" + ",".join(f"`{c}`:{fields[c]}" for c in cols) + ">"


def lag_prev(panel: DataFrame, shift_cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Add ``<c>_prev`` = value of the previous grid row of the same party."""
    party, date = keys
    w = f"OVER (PARTITION BY {ident(party)} ORDER BY {ident(date)})"
    return panel.selectExpr("*", *[f"lag({ident(c)}, 1) {w} AS {ident(prev_name(c))}" for c in _values(shift_cols)])


def pair_prev_lag(df: DataFrame, shift_cols: Sequence[str], value_cols: Sequence[str] | None = None,
                  keys: Sequence[str] = KEYS, bounds: tuple | None = None) -> DataFrame:
    """Yearly panel with previous-year columns by row shift over the dense grid: the column of the year before."""
    value_cols = [c for c in df.columns if c not in keys] if value_cols is None else list(value_cols)
    bounds = bounds or date_bounds(df, keys[1])
    if bounds[0] is None or not _grid_years(bounds):
        return lag_prev(df.select(*keys, *value_cols).limit(0), shift_cols, keys)
    out = [f"cell.cur.{ident(c)} AS {ident(c)}" for c in value_cols]
    out += [f"cell.last.{ident(c)} AS {ident(prev_name(c))}" for c in _values(shift_cols)]
    return _year_rows(df, value_cols, keys, bounds, out, True)


def month_grid(df: DataFrame, keys: Sequence[str] = KEYS, extend: int = 12) -> DataFrame:
    """(party, month start) from each party's first month to its last month + ``extend``."""
    party, date = keys
    m = F.trunc(F.col(date), "month")
    bounds = df.groupBy(party).agg(F.min(m).alias("__lo"), F.max(m).alias("__hi"))
    months = F.sequence(F.col("__lo"), F.add_months(F.col("__hi"), extend), F.expr("interval 1 month"))
    return bounds.select(party, F.explode(months).alias(date))


def forward_fill(df: DataFrame, keys: Sequence[str] = KEYS, value_cols: Sequence[str] | None = None,
                 months: int = 12, extend: int = 12, block_months: int = 60) -> DataFrame:
    """Monthly grid per party with each value carried forward for at most ``months`` months.

    The grid runs from the party's first month to its last month + ``extend``;
    a value observed in month m fills months m..m+``months`` unless a newer
    non-null value exists.  The frame is counted in calendar months
    (``RANGE BETWEEN months PRECEDING``), so it stays right across gaps.

    Several rows of one party and month count as one with each column's largest
    non-null value, whatever their order.  A null party matches nothing: its
    grid is there, without values.  Rows without a date take no part.

    Plan: duplicates collapse in a grouped aggregate on (party, month) with a
    map-side partial, which reads the input once; then one exchange on party,
    whose rows are bounded by the calendar.  Each observed month generates the
    grid up to the next one.  The fill's windows are (party, block of
    ``block_months`` months), which that exchange already satisfies; a block also
    receives the last ``months`` months of observations of the block before it,
    so every frame is complete inside its block and no window group holds more
    than ``block_months + months`` months of rows.
    """
    party, date = keys
    value_cols = [c for c in df.columns if c not in keys] if value_cols is None else list(value_cols)
    B = max(int(block_months), int(months))
    by_month = df.where(F.col(date).isNotNull()).groupBy(party, month_index(F.col(date)).alias("__seen"))
    obs = by_month.agg(F.count(F.lit(1)).alias("__n"), *[F.max(F.col(ident(c))).alias(c) for c in value_cols])
    steps = obs.selectExpr("*", f"lead(__seen) OVER (PARTITION BY {ident(party)} ORDER BY __seen) AS __next")
    grid = (steps.selectExpr("*", f"explode(sequence(__seen, coalesce(__next - 1, __seen + {int(extend)}))) AS __m")
                 .selectExpr(ident(party), "__m", "__m = __seen AS __observed",
                             *[f"CASE WHEN __m = __seen AND {ident(party)} IS NOT NULL THEN {ident(c)} END AS {ident(c)}"
                               for c in value_cols]))
    own = f"CAST(floor(__m / {B}) AS INT)"
    halo = (f"explode(CASE WHEN __observed AND pmod(__m, {B}) >= {B - int(months)} THEN array({own}, {own} + 1) "
            f"ELSE array({own}) END) AS __b")
    blocks = grid.selectExpr("*", halo)
    w = (f"OVER (PARTITION BY {ident(party)}, __b ORDER BY __m "
         f"RANGE BETWEEN {int(months)} PRECEDING AND CURRENT ROW)")
    filled = (blocks.selectExpr(ident(party), "__m", f"__b = {own} AS __grid",
                                *[f"last({ident(c)}, true) {w} AS {ident(c)}" for c in value_cols])
                    .where("__grid"))
    return filled.select(party, month_from_index(F.col("__m")).alias(date), *value_cols)
