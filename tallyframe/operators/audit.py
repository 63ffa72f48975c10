"""Audits: null coincidence between two feature tables, month filter, catalogue coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog import Catalog
from tallyframe.functions.scalar import month_bounds
from tallyframe.functions.sqltext import ident, missing_as_null
from tallyframe.operators.features import available_features
from tallyframe.operators.formulas import prev_name
from tallyframe.sources.schema import DATE, KEYS


def filter_month(df: DataFrame, month: str, col: str = DATE) -> DataFrame:
    """Rows whose date falls in calendar month ``"yyyy-MM"``.

    Written as a half-open date range so that it is pushed to the scan and
    prunes row groups / partitions; a ``date_format(...) == 'yyyy-MM'`` test
    would read everything.
    """
    lo, hi = month_bounds(month)
    d = F.col(col)
    return df.where((d >= F.lit(lo).cast("date")) & (d < F.lit(hi).cast("date")))


def null_audit(model: DataFrame, source: DataFrame, pairs: Sequence[tuple[str, str]] | None = None,
               keys: Sequence[str] = KEYS) -> DataFrame:
    """Null counts of a full outer join of ``model`` and ``source`` on ``keys``, per column pair.

    Output: one row per (model_column, source_column) with ``model_nulls``,
    ``source_nulls`` and ``both_null`` - what counting over
    ``model FULL OUTER JOIN source`` would give - but the join is never
    materialised: both sides are tagged, unioned and grouped by key (with a
    map-side partial aggregate), and the pair counts of each key follow from
    its per-side row and null counts.  A key duplicated on both sides costs
    one aggregate row, not the product of its duplicates.  Rows with a null
    key match nothing and count on their own, as in the join.  Each input is
    read once.  Without ``pairs`` every non-key column that both have is audited.
    """
    if pairs is None:
        pairs = [(c, c) for c in model.columns if c not in keys and c in source.columns]
    n = len(pairs)
    zero = F.lit(0).cast("bigint")

    def side(df: DataFrame, which: int) -> DataFrame:
        cols = [F.col(k) for k in keys]
        cols.append(F.lit(1 if which == 0 else 0).cast("bigint").alias("__mr"))
        cols.append(F.lit(1 if which == 1 else 0).cast("bigint").alias("__sr"))
        for i, pair in enumerate(pairs):
            isnull = F.col(pair[which]).isNull().cast("bigint")
            cols.append((isnull if which == 0 else zero).alias(f"__mn{i}"))
            cols.append((isnull if which == 1 else zero).alias(f"__sn{i}"))
        return df.select(*cols)

    rows = side(model, 0).unionByName(side(source, 1))
    sums = ["__mr", "__sr"] + [f"__{s}{i}" for i in range(n) for s in ("mn", "sn")]
    # Rows with a null key match nothing; they share a group here but count on their own.
    null_key = " OR ".join(f"{ident(k)} IS NULL" for k in keys)
    parts = (rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
                 .select(F.expr(null_key).alias("__lone"), *sums))

    def contributions(i: int) -> list[Column]:
        mr, sr, mn, sn = F.col("__mr"), F.col("__sr"), F.col(f"__mn{i}"), F.col(f"__sn{i}")
        lone = F.col("__lone")
        # Matched key: every model row pairs with every source row.  A missing side
        # behaves as one all-null row.  Lone rows: each row pairs with nothing.
        mr1 = F.when(mr > 0, mr).otherwise(F.lit(1))
        sr1 = F.when(sr > 0, sr).otherwise(F.lit(1))
        mn1 = F.when(mr > 0, mn).otherwise(F.lit(1))
        sn1 = F.when(sr > 0, sn).otherwise(F.lit(1))
        m = F.when(lone, mn + sr).otherwise(mn1 * sr1)
        s = F.when(lone, mr + sn).otherwise(sn1 * mr1)
        b = F.when(lone, mn + sn).otherwise(mn1 * sn1)
        return [F.sum(m).alias(f"m{i}"), F.sum(s).alias(f"s{i}"), F.sum(b).alias(f"b{i}")]

    totals = parts.agg(*[c for i in range(n) for c in contributions(i)])
    rows_out = [F.struct(F.lit(m).alias("model_column"), F.lit(s).alias("source_column"),
                         F.coalesce(F.col(f"m{i}"), zero).alias("model_nulls"),
                         F.coalesce(F.col(f"s{i}"), zero).alias("source_nulls"),
                         F.coalesce(F.col(f"b{i}"), zero).alias("both_null"))
                for i, (m, s) in enumerate(pairs)]
    return totals.select(F.explode(F.array(*rows_out)).alias("r")).select("r.*")


def _input_columns(catalog: Catalog, name: str) -> list[str]:
    """Columns a feature reads."""
    return sorted(catalog.current_dependencies(name)) + sorted(prev_name(p) for p in catalog.shifted_dependencies(name))


def coverage_report(df: DataFrame, catalog: Catalog | None = None,
                    names: Sequence[str] | None = None) -> DataFrame:
    """One row per feature: kind, calculable or skipped, missing accounts, and how many
    rows of ``df`` have all of the feature's inputs (neither null nor NaN).

    Availability is decided from the schema alone (no job), by the rule of
    ``compute_features(skip_unavailable=True)``; the row counts are
    one aggregate pass over ``df`` computing every feature's count at once.
    """
    catalog = catalog or Catalog.default()
    names = catalog.names if names is None else list(names)
    calculable, skipped = available_features(catalog, df.columns, names)
    ok = set(calculable)
    counts = []
    for i, n in enumerate(names):
        if n in ok:
            cond = " AND ".join(f"{ident(c)} IS NOT NULL" for c in _input_columns(catalog, n)) or "true"
            counts.append(f"count_if({cond}) AS c{i}")
    # One global aggregate: a select of aggregate expressions.
    read = sorted({c for n in calculable for c in _input_columns(catalog, n)})
    totals = df.selectExpr(*[missing_as_null(c) for c in read]).selectExpr(*counts) if counts else df.sparkSession.range(1)
    entries = []
    for i, n in enumerate(names):
        f = catalog[n]
        count = f"c{i}" if n in ok else "CAST(NULL AS BIGINT)"
        missing = ",".join(skipped.get(n, []))
        entries.append(f"named_struct('position', {i + 1}, 'feature', {_str(n)}, 'kind', {_str(f.kind)}, "
                       f"'status', {_str('calculable' if n in ok else 'skipped')}, "
                       f"'missing_accounts', {_str(missing)}, 'complete_rows', {count})")
    return totals.selectExpr(f"inline(array({', '.join(entries)}))")


def _str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
