"""Features after restated accounts: only what depends on them is computed again, for the keys that they touch.

``Catalog`` knows each feature's accounts; read the other way round that is an index from account to features,
through ratios of ratios and last year's figures.  :func:`recompute` takes the stored features, the restated
statement rows and the accounts that changed: it reads those rows' inputs of the affected features and
no other column, computes these, and puts them over the stored ones by a join on the key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.catalog import Catalog
from tallyframe.functions.sqltext import ident
from tallyframe.operators.features import compute_features
from tallyframe.operators.formulas import prev_name
from tallyframe.sources.schema import KEYS


def account_index(catalog: Catalog | None = None) -> dict[str, list[str]]:
    """Account -> the features that read it, for this or last year, in catalogue order."""
    catalog = catalog or Catalog.default()
    out: dict[str, list[str]] = {}
    for name in catalog.names:
        for account in sorted(catalog.raw_dependencies(name)):
            out.setdefault(account, []).append(name)
    return out


def affected_features(accounts: Iterable[str], catalog: Catalog | None = None, names: Sequence[str] | None = None) -> list[str]:
    """Features (of ``names``) that any of ``accounts`` enters, in catalogue order."""
    catalog = catalog or Catalog.default()
    index = account_index(catalog)
    hit = {n for a in accounts for n in index.get(a, [])}
    return [n for n in catalog.names if n in hit and (names is None or n in names)]


def inputs_of(names: Sequence[str], catalog: Catalog | None = None) -> list[str]:
    """Columns of paired statements that ``names`` read."""
    catalog = catalog or Catalog.default()
    out: dict[str, None] = {}
    for n in names:
        out.update(dict.fromkeys(sorted(catalog.current_dependencies(n))))
        out.update(dict.fromkeys(prev_name(a) for a in sorted(catalog.shifted_dependencies(n))))
    return list(out)


def recompute_changed(restated: DataFrame, accounts: Iterable[str], catalog: Catalog | None = None,
                      names: Sequence[str] | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys of ``restated`` (paired rows with their new figures) with the affected features of ``names``."""
    catalog = catalog or Catalog.default()
    hit = affected_features(accounts, catalog, names)
    rows = restated.select(*(F.col(ident(c)) for c in (*keys, *(c for c in inputs_of(hit, catalog) if c not in keys))))
    return compute_features(rows, catalog, hit, keys=keys)


def recompute(stored: DataFrame, restated: DataFrame, accounts: Iterable[str], catalog: Catalog | None = None,
              keys: Sequence[str] = KEYS) -> DataFrame:
    """``stored`` features with those that ``accounts`` enter computed anew for the keys of ``restated``.

    ``restated`` has one row a key.  Keys that ``stored`` doesn't have are new filings, all of whose features are wanted: they
    are not added here.  A key with a null part matches nothing.

    Stored rows are wide and mostly stay as they are: the restated ones are the hashed side of the join, so the stored ones
    are not sorted, nor moved where they are bucketed by the keys (:func:`tallyframe.sources.sinks.stage_panel`).
    """
    accounts = list(accounts)
    feature_cols = [c for c in stored.columns if c not in keys]
    fresh = recompute_changed(restated, accounts, catalog, feature_cols, keys)
    changed = [c for c in fresh.columns if c not in keys]
    if not changed:
        return stored
    mark = "restated"
    while mark in stored.columns:
        mark += "_"
    new = fresh.select(*(F.col(ident(k)) for k in keys), F.struct(*(F.col(ident(c)) for c in changed)).alias(mark))
    joined = stored.join(new.hint("shuffle_hash"), list(keys), "left")
    put = set(changed)
    return joined.selectExpr(*(ident(k) for k in keys), *(
        f"CASE WHEN {ident(mark)} IS NOT NULL THEN {ident(mark)}.{ident(c)} ELSE {ident(c)} END AS {ident(c)}" if c in put else ident(c)
        for c in feature_cols))
