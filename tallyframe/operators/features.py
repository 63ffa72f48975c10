"""Feature operators: compile a catalogue into column expressions.

Every feature is a row-wise expression of one statement row (plus its
previous-year columns ``<code>_prev``), so a whole catalogue becomes a few
stacked projections and no shuffle:

0. keys + the account columns read, as doubles with NaN read as missing;
1. keys + every aggregate the requested features need (each computed once),
   plus the raw columns custom formulas and raw ratio parents read;
2. the numerators and denominators of custom formulas, each computed once;
3. keys + the requested features in catalogue order; ratios refer to the
   aggregate columns of step 1 by name, ratios of ratios (one more projection
   per level) to those of the level below.

Catalyst keeps the aggregate and feature projections apart because the aggregate expressions
are referenced by several ratios (``CollapseProject`` does not duplicate
non-trivial expressions), so each sum is evaluated once per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog import (
    Aggregate, Catalog, ConfigFeature, Custom, Ratio, base_account, is_last_year,
)
from tallyframe.functions import sqltext
from tallyframe.functions.sqltext import Sql, alias, ident
from tallyframe.operators.formulas import formula_inputs, formula_parts, prev_name

KEYS = ("party_id", "data_date")


def available_features(catalog: Catalog, columns: Iterable[str], names: Iterable[str] | None = None,
                       need_prev: bool = True) -> tuple[list[str], dict[str, list[str]]]:
    """Split ``names`` into (calculable, skipped -> sorted missing inputs).

    A feature is calculable when every account it reads is a column: last year's
    figures as ``<code>_prev`` columns, or, without ``need_prev``, as accounts of
    a frame that is still to be paired.
    """
    cols = set(columns)
    calculable, skipped = [], {}
    for n in (catalog.names if names is None else list(names)):
        if need_prev:
            needed = catalog.current_dependencies(n) | {prev_name(d) for d in catalog.shifted_dependencies(n)}
        else:
            needed = catalog.raw_dependencies(n)
        missing = needed - cols
        if missing:
            skipped[n] = sorted(missing)
        else:
            calculable.append(n)
    return calculable, skipped


def aggregate_sql(f: Aggregate) -> Sql:
    return sqltext.signed_sum(list(f.added), list(f.subtracted))


def compute_features(df: DataFrame, catalog: Catalog | None = None, names: Sequence[str] | None = None,
                     keys: Sequence[str] = KEYS, carry: Sequence[str] = (),
                     skip_unavailable: bool = False) -> DataFrame:
    """Keys (+ ``carry``) and one double column per requested feature, in catalogue order.

    ``df`` holds one row per statement with account columns and, for custom
    ratios, ``<code>_prev`` columns (see :func:`tallyframe.operators.panel.pair_prev`).
    With ``skip_unavailable`` features whose inputs are absent are left out
    (see :func:`tallyframe.operators.audit.coverage_report` for the list);
    otherwise a missing input is an analysis error.
    """
    catalog = catalog or Catalog.default()
    names = catalog.names if names is None else list(names)
    if skip_unavailable:
        names, _ = available_features(catalog, df.columns, names)
    order = {n: i for i, n in enumerate(catalog.names)}
    names = sorted(dict.fromkeys(names), key=lambda n: order[n])
    closure = catalog.closure(names)
    fixed = [*keys, *carry]

    aggregates = [f for f in catalog.subset(closure) if isinstance(f, Aggregate)]
    agg_names = {f.name for f in aggregates}
    raw: dict[str, None] = {}
    for f in catalog.subset(closure):
        if isinstance(f, Custom):
            cur, prev = formula_inputs(f.name)
            raw.update(dict.fromkeys(cur))
            raw.update(dict.fromkeys(prev_name(c) for c in prev))
        elif isinstance(f, Ratio):
            for parent in (f.numerator, f.denominator):
                if parent not in catalog:
                    raw.setdefault(parent)
    raw_cols = [c for c in raw if c not in fixed and c not in agg_names]

    accounts = list(dict.fromkeys([*raw_cols, *(a for f in aggregates for a in (*f.added, *f.subtracted)
                                                 if a not in fixed)]))
    stage0 = df.selectExpr(*[ident(c) for c in fixed], *[sqltext.missing_as_null(c) for c in accounts])
    stage1 = stage0.selectExpr(*[ident(c) for c in (*fixed, *raw_cols)],
                               *[alias(aggregate_sql(f), f.name) for f in aggregates])

    # Numerators and denominators of custom formulas are columns of their own, evaluated once a row.
    customs = [f.name for f in catalog.subset(closure) if isinstance(f, Custom)]
    have = [*fixed, *raw_cols, *(f.name for f in aggregates)]
    frame, quotient = stage1, {}
    if customs:
        halves = []
        for n in customs:
            num, den = formula_parts(n)
            quotient[n] = (f"__num_{n}", f"__den_{n}")
            halves += [alias(num, quotient[n][0]), alias(den, quotient[n][1])]
        frame = frame.selectExpr(*[ident(c) for c in have], *halves)
        have += [c for pair in quotient.values() for c in pair]

    def expr(name: str) -> str:
        if name not in level or not level[name]:
            return ident(name)
        f = catalog[name]
        num, den = (f.numerator, f.denominator) if isinstance(f, Ratio) else quotient[name]
        return f"CAST({sqltext.safe_div(sqltext.col(num), sqltext.col(den)).text} AS DOUBLE)"

    # A ratio of ratios reads its parents by name, one projection a level.
    level = _levels(catalog, closure)
    top = max(level.values(), default=0)
    for k in range(1, top):
        made = [n for n in closure if level[n] == k]
        frame = frame.selectExpr(*[ident(c) for c in have], *[alias(expr(n), n) for n in made])
        have += made
    return frame.selectExpr(*[ident(c) for c in fixed],
                            *[alias(f"CAST({ident(n)} AS DOUBLE)" if level[n] < top else expr(n), n) for n in names])


def _levels(catalog: Catalog, names: Sequence[str]) -> dict[str, int]:
    """0 for aggregates, 1 for quotients of columns, one more than the highest parent for ratios of ratios."""
    out: dict[str, int] = {}

    def of(n: str) -> int:
        if n not in catalog or isinstance(catalog[n], Aggregate):
            return 0
        if n not in out:
            out[n] = 1 + max((of(p) for p in catalog.parents(n)), default=0)
        return out[n]

    return {n: of(n) for n in names}


def aggregate_features(df: DataFrame, catalog: Catalog | None = None, **kw) -> DataFrame:
    catalog = catalog or Catalog.default()
    return compute_features(df, catalog, [f.name for f in catalog.of_kind("aggregate")], **kw)


def ratio_features(df: DataFrame, catalog: Catalog | None = None, names: Sequence[str] | None = None,
                   **kw) -> DataFrame:
    catalog = catalog or Catalog.default()
    names = [f.name for f in catalog.of_kind("ratio")] if names is None else names
    return compute_features(df, catalog, names, **kw)


def custom_features(df: DataFrame, catalog: Catalog | None = None, names: Sequence[str] | None = None,
                    **kw) -> DataFrame:
    catalog = catalog or Catalog.default()
    names = [f.name for f in catalog.of_kind("custom")] if names is None else names
    return compute_features(df, catalog, names, **kw)


def config_column(name: str) -> str:
    """Column a flat-dialect account refers to: ``X_1y`` / ``X_ly`` -> ``X_prev``."""
    return prev_name(base_account(name)) if is_last_year(name) else name


def config_feature_sql(f: ConfigFeature) -> Sql:
    num = sqltext.signed_sum([config_column(c) for c in f.numerator], [config_column(c) for c in f.neg_numerator])
    if not f.has_denominator:
        return Sql(f"CAST({num.text} AS DOUBLE)")
    den = sqltext.signed_sum([config_column(c) for c in f.denominator],
                             [config_column(c) for c in f.neg_denominator])
    # Coalesced sums are never null, so only the zero test can fire.
    return sqltext.safe_div(num, den)


def config_features(df: DataFrame, features: Sequence[ConfigFeature], keys: Sequence[str] = KEYS,
                    carry: Sequence[str] = ()) -> DataFrame:
    """Flat-dialect features, one projection; missing accounts count as 0."""
    fixed = [*keys, *carry]
    accounts = list(dict.fromkeys(config_column(c) for f in features for c in f.columns()))
    clean = df.selectExpr(*[ident(c) for c in fixed], *[sqltext.missing_as_null(c) for c in accounts
                                                        if c not in fixed])
    return clean.selectExpr(*[ident(c) for c in fixed],
                            *[alias(config_feature_sql(f), f.name) for f in features])


def features_long(features: DataFrame, keys: Sequence[str] = KEYS, drop_nulls: bool = False,
                  name_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Wide feature table -> (keys, feature, value); multiplies rows by the feature count.

    Null features keep their rows, so the wide table can be had back; ``drop_nulls`` leaves them out.
    """
    value_cols = [c for c in features.columns if c not in keys]
    # One row's values as an array that is exploded: unpivot would plan a projection of its own for every feature in every task.
    at = "__at"
    values = f"posexplode(array({', '.join(ident(c) for c in value_cols)})) AS ({at}, {ident(value_col)})"
    names = F.array(*(F.lit(c) for c in value_cols))
    out = features.selectExpr(*(ident(k) for k in keys), values).select(
        *(F.col(ident(k)) for k in keys), F.get(names, F.col(at)).alias(name_col), F.col(ident(value_col)))
    return out.where(F.col(value_col).isNotNull()) if drop_nulls else out
