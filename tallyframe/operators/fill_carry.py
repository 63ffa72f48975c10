"""Forward fill by a segmented scan: what a block of months needs from earlier ones is carried in, not copied.

:func:`tallyframe.operators.panel.forward_fill` gives every block the last ``months`` months of
observations before it, so blocks can't be shorter than ``months``.  Here a
block is summed up by the last observation of each column in it (month and
value); a scan over a party's summaries, one row a block, gives each block the last
observation before it; and blocks fill themselves from that one row.  Any ``months`` goes with
any block length, no row is copied, and no window group is longer than a block and
its carry, or a party's blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalar import month_from_index, month_index
from tallyframe.functions.sqltext import ident
from tallyframe.sources.schema import KEYS


def _free(taken: Sequence[str], *names: str) -> list[str]:
    """Each name, with underscores added until no column has it."""
    used, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out


def forward_fill_carry(df: DataFrame, keys: Sequence[str] = KEYS, value_cols: Sequence[str] | None = None,
                       months: int = 12, extend: int = 12, block_months: int = 60) -> DataFrame:
    """The result of ``forward_fill(df, keys, value_cols, months, extend)``.

    Several rows of one party and month count as one with each column's largest non-null value; a null party's
    grid is there without values; rows without a date take no part.
    """
    party, date = keys
    value_cols = [c for c in df.columns if c not in keys] if value_cols is None else list(value_cols)
    seen, block, month, upto, on_grid = _free(df.columns, "seen_month", "block", "grid_month", "next_seen", "on_grid")
    p, size = ident(party), int(block_months)
    carry = dict(zip(value_cols, _free([*df.columns, seen, block, month, upto, on_grid], *(f"last_{c}" for c in value_cols))))

    # One row per party and observed month; of each column its month and value.
    by_month = df.where(F.col(ident(date)).isNotNull()).groupBy(F.col(p), month_index(F.col(ident(date))).alias(seen))
    obs = by_month.agg(F.count(F.lit(1)), *(F.max(F.col(ident(c))).alias(c) for c in value_cols)).selectExpr(
        p, seen, f"CAST(floor({seen} / {size}) AS INT) AS {block}",
        *(f"CASE WHEN {p} IS NOT NULL AND {ident(c)} IS NOT NULL THEN struct({seen} AS m, {ident(c)} AS v) END AS {ident(carry[c])}" for c in value_cols))

    # Summaries, the scan over them, and the blocks without observations up to the next one or the end.
    last = [ident(carry[c]) for c in value_cols]
    sums = obs.groupBy(p, block).agg(F.min(seen).alias("lo"), F.max(seen).alias("hi"), *(F.max(ident(carry[c])).alias(carry[c]) for c in value_cols))
    over = f"OVER (PARTITION BY {p} ORDER BY {block}"
    scanned = sums.selectExpr(p, block, f"lead(lo) {over}) AS next_lo", "hi",
                              *(f"last({x}, true) {over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {x}" for x in last))
    # Block b hands its state to all blocks up to the one that the next observation (or the extended end) stands in.
    final = f"CAST(floor(coalesce(next_lo, hi + {int(extend)}) / {size}) AS INT)"
    carried = scanned.where(f"{final} > {block}").selectExpr(p, f"explode(sequence({block} + 1, {final})) AS {block}", *last)

    # The grid: each observed month generates the months up to the next observed one.
    steps = obs.selectExpr("*", f"lead({seen}) OVER (PARTITION BY {p} ORDER BY {seen}) AS {upto}")
    grid = steps.selectExpr("*", f"explode(sequence({seen}, coalesce({upto} - 1, {seen} + {int(extend)}))) AS {month}")
    rows = grid.selectExpr(p, f"CAST(floor({month} / {size}) AS INT) AS {block}", month, f"true AS {on_grid}",
                           *(f"CASE WHEN {month} = {seen} THEN {x} END AS {x}" for x in last))
    starts = carried.selectExpr(p, block, f"{block} * {size} - 1 AS {month}", f"false AS {on_grid}", *last)

    fill = f"OVER (PARTITION BY {p}, {block} ORDER BY {month} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    filled = rows.unionByName(starts).selectExpr(p, month, on_grid, *(f"last({x}, true) {fill} AS {x}" for x in last)).where(on_grid)
    out = filled.selectExpr(p, month, *(f"CASE WHEN {month} - {x}.m <= {int(months)} THEN {x}.v END AS {ident(c)}"
                                        for c, x in zip(value_cols, last)))
    return out.select(F.col(p), month_from_index(F.col(month)).alias(date), *(F.col(ident(c)) for c in value_cols))
