"""tallyframe: financial-statement features on Spark DataFrames.

Typical job::

    from tallyframe import Catalog, pair_prev, normalize_amounts, compute_features
    cat = Catalog.default()
    paired = pair_prev(statements, cat.shifted_accounts(), cat.accounts())
    features = compute_features(normalize_amounts(paired, index, amount_cols), cat)
"""

from tallyframe.catalog import Catalog, ConfigFeature, load_ratio_config
from tallyframe.operators.audit import coverage_report, filter_month, null_audit
from tallyframe.operators.features import (
    aggregate_features, available_features, compute_features, config_features, custom_features,
    features_long, ratio_features,
)
from tallyframe.operators.fill_carry import forward_fill_carry
from tallyframe.operators.formulas import register_formula
from tallyframe.operators.normalize import normalize_amounts
from tallyframe.operators.panel import (
    dedupe_latest, forward_fill, lag_prev, month_grid, pair_prev, pair_prev_lag, year_grid, year_panel,
)
from tallyframe.operators.restate import recompute
from tallyframe.operators.spine import attach_prev_month_end, attach_to_spine, restrict_to_spine
from tallyframe.plans.pipelines import catalogue_job, config_job, panel_job, spine_job
from tallyframe.sources.keyed_store import KeyedStore
from tallyframe.sources.layout import ClusteredStatements, scan_closing_months
from tallyframe.sources.published import Published, publish_table
from tallyframe.sources.quarantine import write_checked
from tallyframe.sources.readers import (
    map_columns, read_index, read_spine, read_statements, scan_statements_window,
)
from tallyframe.sources.sinks import stage_panel, write_features
from tallyframe.sources.staging import stage_or_reuse

__all__ = [
    "Catalog", "ConfigFeature", "load_ratio_config",
    "coverage_report", "filter_month", "null_audit",
    "aggregate_features", "available_features", "compute_features", "config_features",
    "custom_features", "features_long", "ratio_features", "register_formula", "normalize_amounts",
    "dedupe_latest", "forward_fill", "lag_prev", "month_grid", "pair_prev", "pair_prev_lag",
    "year_grid", "year_panel", "attach_prev_month_end", "attach_to_spine", "restrict_to_spine",
    "catalogue_job", "config_job", "panel_job", "spine_job", "map_columns", "read_index",
    "read_spine", "read_statements", "scan_statements_window", "stage_panel", "write_features",
    "forward_fill_carry", "recompute", "KeyedStore", "ClusteredStatements", "scan_closing_months", "Published",
    "publish_table", "write_checked", "stage_or_reuse",
]
