"""Registered queries: one per operator family, each over the whole derived tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Inputs are
derived from the test tables by :mod:`tallyframe.sources.fixtures`, so every
query's work grows with the data.  Queries that read the derived statements
in several branches derive them once and stage them as Parquet in the shared
checkpoint folder (``fx.staged_statements``), as a job over a stored statement
table would read that table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.catalog import Catalog, Custom, EXAMPLE_RATIO_CONFIG, Ratio, load_ratio_config
from tallyframe.operators import audit, features, fill_carry, formulas, normalize, panel, restate, spine
from tallyframe.plans import pipelines
from tallyframe.sources import fixtures as fx
from tallyframe.sources import keyed_store, layout, published, quarantine, readers, sinks, staging
from tallyframe.sources.schema import ACCOUNT_CODES, FLAG, KEYS, PARTY, PHYSICAL_NAMES
from tallyframe.streaming import pairing_stream

# Query parameters (fixed; every query still reads its whole input).
WINDOW_MIN, WINDOW_MAX = "1999-06-15", "2001-03-31"
AUDIT_MONTH = "2000-12"
SPARSE_MONTH = "1999-06"
YEARLY_BOUNDS = (dt.date(1997, 1, 15), dt.date(2001, 3, 31))  # the window with its look-back of 29 months
TABLE_BUCKETS = 8
BASE_MONTH = 199506
OWN_FORMULA = "GROWTH_OF_A_1"
RESTATED = ("A_15", "P_3")

Query = Callable[[SparkSession, str], DataFrame]


def _cat() -> Catalog:
    return Catalog.default()


def _shifted() -> list[str]:
    return _cat().shifted_accounts()


def figures() -> list[str]:
    """Columns of amounts and features: accounts, last year's accounts, the catalogue."""
    return [*ACCOUNT_CODES, *map(formulas.prev_name, ACCOUNT_CODES), *_cat().names]


def q_scan_statements_window(spark, d):
    return readers.scan_statements_window(fx.sparse(spark, d), WINDOW_MIN, WINDOW_MAX)


def q_map_columns(spark, d):
    return readers.map_columns(fx.statements_raw(spark, d), ACCOUNT_CODES, fx.raw_mapping())


def q_parse_dates(spark, d):
    raw = fx.statements_raw(spark, d)
    return raw.select(F.col("Party_Id").alias(PARTY), F.col("Prev_Financial_Indicator").alias(FLAG),
                      F.col("DATA_DATE").alias("date_text"),
                      readers.parse_date_any(F.col("DATA_DATE")).alias("data_date"))


def q_restrict_to_spine(spark, d):
    base = fx.staged_statements(spark, d)
    st = fx.statements_closing(spark, d, base)
    st = st.select(PARTY, F.try_to_date("close_date", "dd.MM.yyyy").alias("data_date"), FLAG,
                   *ACCOUNT_CODES)
    return spine.restrict_to_spine(st, readers.read_spine(spark, fx.spine(spark, d, base)))


def q_year_grid(spark, d):
    return panel.year_panel(fx.staged_statements(spark, d))


def q_pair_prev_flag(spark, d):
    return panel.pair_prev(fx.statements_flagged(spark, d), _shifted(), list(ACCOUNT_CODES))


def q_pair_prev_lag(spark, d):
    return panel.pair_prev_lag(fx.staged_statements(spark, d), _shifted(), list(ACCOUNT_CODES))


def q_normalize_multiply(spark, d):
    return normalize.normalize_amounts(fx.statements(spark, d), fx.inflation(spark, d), ACCOUNT_CODES,
                                       mode="multiply")


def q_normalize_divide(spark, d):
    return normalize.normalize_amounts(fx.statements(spark, d), fx.inflation(spark, d), ACCOUNT_CODES,
                                       mode="divide")


def q_agg_features(spark, d):
    return features.aggregate_features(fx.statements(spark, d), _cat())


def _ratio_family(prefix: str) -> Query:
    def q(spark, d):
        cat = _cat()
        return features.ratio_features(fx.statements(spark, d), cat, cat.family(prefix))
    q.__name__ = f"q_ratio_{prefix.strip('_').lower()}"
    return q


def q_custom_flag(spark, d):
    paired = panel.pair_prev(fx.statements_flagged(spark, d), _shifted(), list(ACCOUNT_CODES))
    return features.custom_features(paired, _cat())


def q_custom_lag(spark, d):
    paired = panel.pair_prev_lag(fx.staged_statements(spark, d), _shifted(), list(ACCOUNT_CODES))
    return features.custom_features(paired, _cat())


def q_config_features(spark, d):
    base = fx.staged_statements(spark, d)
    return pipelines.config_job(fx.spine(spark, d, base), fx.statements_closing(spark, d, base),
                                load_ratio_config(EXAMPLE_RATIO_CONFIG), fx.inflation(spark, d))


def q_attach_to_spine(spark, d):
    cat = _cat()
    base = fx.staged_statements(spark, d)
    paired = panel.pair_prev(fx.statements_flagged(spark, d, base), _shifted(), list(ACCOUNT_CODES))
    feats = features.compute_features(paired, cat)
    return spine.attach_to_spine(readers.read_spine(spark, fx.spine(spark, d, base)), feats)


def q_attach_prev_month_end(spark, d):
    base = fx.staged_statements(spark, d)
    return spine.attach_prev_month_end(fx.month_spine(spark, d, base), base, party_type="decimal(16,0)")


def q_month_grid(spark, d):
    return panel.month_grid(fx.sparse(spark, d))


def q_forward_fill(spark, d):
    return panel.forward_fill(fx.sparse(spark, d))


def q_null_audit(spark, d):
    model, source = fx.audit_sides(spark, d, fx.staged_statements(spark, d))
    return audit.null_audit(model, source, [("feature_x", "raw_feature")])


def q_null_audit_month(spark, d):
    model, source = fx.audit_sides(spark, d, fx.staged_statements(spark, d))
    return audit.null_audit(audit.filter_month(model, AUDIT_MONTH), audit.filter_month(source, AUDIT_MONTH),
                            [("feature_x", "raw_feature")])


def q_filter_month(spark, d):
    return audit.filter_month(fx.sparse(spark, d), SPARSE_MONTH)


def q_coverage_report(spark, d):
    """Coverage when only the 23 accounts with descriptive names exist."""
    mapped = sorted(PHYSICAL_NAMES)
    fl = fx.statements_flagged(spark, d).select(*KEYS, FLAG, *mapped)
    shift = [c for c in _shifted() if c in mapped]
    return audit.coverage_report(panel.pair_prev(fl, shift, mapped), _cat())


def q_compute_features(spark, d):
    return pipelines.catalogue_job(fx.statements_raw(spark, d), fx.inflation(spark, d), _cat(),
                                   fx.raw_mapping())


def q_features_long(spark, d):
    """All 474 features of every pair, a row each."""
    paired = panel.pair_prev(fx.statements_flagged(spark, d), _shifted(), list(ACCOUNT_CODES))
    return features.features_long(features.compute_features(paired, _cat()))


def q_panel_features(spark, d):
    return pipelines.panel_job(fx.staged_statements(spark, d), _cat())


def q_stage_panel(spark, d):
    return sinks.stage_panel(panel.year_panel(fx.staged_statements(spark, d)))


def q_read_statements(spark, d):
    """Keys, flags 0/1 and only the 23 accounts with descriptive names."""
    return readers.read_statements(spark, fx.statements_flagged(spark, d), sorted(PHYSICAL_NAMES), flags=(0, 1))


def q_write_features(spark, d):
    """Aggregates written as ORC to the shared folder, read back."""
    path = f"{sinks.owned_dir(spark, 'features')}/orc"
    sinks.write_features(features.aggregate_features(fx.statements(spark, d), _cat()), path, fmt="orc")
    return spark.read.orc(path)


def q_write_table(spark, d):
    """Aggregates as a managed ORC table bucketed by party, read back."""
    target = f"tallyframe_features.aggregates_{uuid.uuid4().hex}"  # runs in one warehouse don't meet
    sinks.write_features(features.aggregate_features(fx.statements(spark, d), _cat()), target, fmt="orc",
                         bucket_by=[PARTY], num_buckets=TABLE_BUCKETS)
    return spark.table(target)


def q_null_audit_all(spark, d):
    """Every account of the statements against the restated ones of parties not divisible by 5."""
    base = fx.staged_statements(spark, d)
    restated = fx.statements_flagged(spark, d, base).where((F.col(FLAG) == 1) & (F.col(PARTY) % 5 != 0))
    return audit.null_audit(base, restated.drop(FLAG))


def q_coverage_report_unpaired(spark, d):
    """A frame without last year's columns: formulas that read them are skipped."""
    return audit.coverage_report(fx.statements(spark, d), _cat())


def q_yearly_job(spark, d):
    """Window scan of a stored table -> inflation -> dense panel of the window -> lag -> 474 features."""
    scan = readers.scan_statements_window(fx.staged_statements(spark, d), WINDOW_MIN, WINDOW_MAX)
    return pipelines.panel_job(scan, _cat(), index=readers.read_index(spark, fx.inflation(spark, d)), bounds=YEARLY_BOUNDS)


def q_pair_prev_flag_dirty(spark, d):
    return panel.pair_prev(fx.flagged_dirty(spark, d), ["A_1"], ["A_1", "P_3"])


def q_forward_fill_dup(spark, d):
    return panel.forward_fill(fx.sparse_dirty(spark, d))


def q_map_columns_dirty(spark, d):
    return readers.map_columns(fx.raw_dirty(spark, d), ACCOUNT_CODES, fx.raw_mapping())


def q_normalize_divide_dirty(spark, d):
    return normalize.normalize_amounts(fx.statements(spark, d), fx.inflation_dirty(spark, d), ACCOUNT_CODES,
                                       mode="divide")


def q_attach_prev_month_end_dirty(spark, d):
    base = fx.staged_statements(spark, d)
    return spine.attach_prev_month_end(fx.month_spine_dirty(spark, d, base), base, party_type="decimal(16,0)")


def q_flagship(spark, d):
    base = fx.staged_statements(spark, d)
    return pipelines.spine_job(fx.spine(spark, d, base), fx.statements_flagged(spark, d, base),
                               fx.inflation(spark, d), _cat())


def q_restrict_to_spine_filtered(spark, d):
    """The spine's runtime filter at the scan, then the semi join."""
    base = fx.staged_statements(spark, d)
    st = fx.statements_closing(spark, d, base)
    st = st.select(PARTY, F.try_to_date("close_date", "dd.MM.yyyy").alias("data_date"), FLAG, *ACCOUNT_CODES)
    return spine.restrict_to_spine(st, readers.read_spine(spark, fx.spine(spark, d, base)), runtime_filter=True)


def q_flagship_filtered(spark, d):
    base = fx.staged_statements(spark, d)
    return pipelines.spine_job(fx.spine(spark, d, base), fx.statements_flagged(spark, d, base),
                               fx.inflation(spark, d), _cat(), runtime_filter=True)


def q_publish_features(spark, d):
    """Aggregates of even parties published, then overwritten by themselves and those of the others."""
    feats = features.aggregate_features(fx.statements(spark, d), _cat())
    target = published.Published(spark, sinks.owned_dir(spark, "published"))
    target.write(feats.where(F.col(PARTY) % 2 == 0))
    target.write(target.read().unionByName(feats.where(F.col(PARTY) % 2 != 0)))
    return target.read()


def q_publish_table(spark, d):
    """The same through the catalogue: bucketed generations behind a view."""
    feats = features.aggregate_features(fx.statements(spark, d), _cat())
    name = f"tallyframe_features.published_{uuid.uuid4().hex}"
    layout_ = {"fmt": "orc", "bucket_by": [PARTY], "num_buckets": TABLE_BUCKETS}
    published.publish_table(feats.where(F.col(PARTY) % 2 == 0), name, **layout_)
    published.publish_table(spark.table(name).unionByName(feats.where(F.col(PARTY) % 2 != 0)), name, keep=1, **layout_)
    return spark.table(name)


def q_upsert_statements(spark, d):
    """Restated figures and first filings merged out of order, with a compaction in between: the newest of each key."""
    filed = fx.statements_flagged(spark, d, fx.staged_statements(spark, d))
    rows, flag, third = filed.drop(FLAG), F.col(FLAG), F.col(PARTY) % 3 == 0
    store = keyed_store.KeyedStore(spark, sinks.owned_dir(spark, "store"), rows.schema, buckets=TABLE_BUCKETS)
    store.upsert(filed.where((flag == 1) & third), 3)
    store.upsert(filed.where(flag == 0), 1)
    store.compact()
    store.upsert(filed.where((flag == 1) & ~third), 2)
    return store.read()


def q_pair_prev_stream(spark, d):
    """Flags of a filing that land apart, paired by the stream as they come."""
    filed = fx.statements_flagged(spark, d, fx.staged_statements(spark, d))
    root, flag, odd = sinks.owned_dir(spark, "filings"), F.col(FLAG), F.col(PARTY) % 2 != 0
    store = keyed_store.KeyedStore(spark, f"{root}/store", pairing_stream.pair_schema(filed.schema, _shifted(), ACCOUNT_CODES),
                                   buckets=TABLE_BUCKETS)
    for k, part in enumerate(((flag == 1) & odd, flag == 0, (flag == 1) & ~odd)):
        filed.where(part).write.parquet(f"{root}/in/{k}")
        # All years are loaded at once, so no closing date is over.
        pairing_stream.start_pairing_stream(spark, f"{root}/in/*", filed.schema, store, f"{root}/checkpoint", _shifted(),
                                            list(ACCOUNT_CODES), delay="20000 days").awaitTermination()
    return store.read()


def q_stage_reuse(spark, d):
    """The year panel staged by one job and found again by a second one."""
    panels = staging.StagedPanels(spark, sinks.owned_dir(spark, "panels"))

    def job() -> tuple[DataFrame, bool]:
        return panels.stage(panel.year_panel(fx.statements(spark, d)))

    first, (again, found) = job(), job()
    if first[1] or not found:
        raise RuntimeError("the panel was not found again")
    return again


def q_scan_clustered(spark, d):
    """The window scan on a table clustered by closing month and party."""
    table = layout.ClusteredStatements(spark, sinks.owned_dir(spark, "clustered"))
    table.write(fx.sparse(spark, d))
    return table.scan(WINDOW_MIN, WINDOW_MAX)


def q_normalize_base_month(spark, d):
    """Amounts in the money of one month."""
    return normalize.normalize_amounts(fx.statements(spark, d), fx.inflation(spark, d), ACCOUNT_CODES, base_month=BASE_MONTH)


def q_extended_catalogue(spark, d):
    """A catalogue with ratios of ratios and a formula of the caller's own."""
    formulas.register_formula(OWN_FORMULA, lambda c, p: (c("A_1") - p("A_1"), c("P_3")))
    first, second, third = [*_cat().family("LQ_")[:2], _cat().family("DC_")[0]]
    cat = Catalog([*_cat(), Ratio("RATIO_OF_RATIOS", first, third), Ratio("RATIO_ABOVE", "RATIO_OF_RATIOS", second), Custom(OWN_FORMULA, ())])
    paired = panel.pair_prev(fx.statements_flagged(spark, d), ["A_1"], list(ACCOUNT_CODES))
    return features.compute_features(paired, cat, ["RATIO_OF_RATIOS", "RATIO_ABOVE", OWN_FORMULA])


def q_forward_fill_carry(spark, d):
    """The fill of 12 months by a carry from block to block."""
    return fill_carry.forward_fill_carry(fx.sparse(spark, d))


def q_forward_fill_carry_long(spark, d):
    """Values kept for 30 months over blocks of 7, from a table with repeated months and rows without party."""
    return fill_carry.forward_fill_carry(fx.sparse_dirty(spark, d), months=30, block_months=7)


def _checked(spark, d) -> quarantine.Checked:
    return quarantine.write_checked(fx.raw_dirty(spark, d), f"{sinks.owned_dir(spark, 'checked')}/rows", ACCOUNT_CODES, fx.raw_mapping())


def q_quarantine_rows(spark, d):
    """Raw keys of the rows that have malformed values, and which."""
    raw = F.from_json("raw_row", "Party_Id string, DATA_DATE string, Prev_Financial_Indicator string")
    return _checked(spark, d).rejected.select(F.array_join("malformed", ",").alias("malformed"), raw.alias("r")).select("malformed", "r.*")


def q_quarantine_accepted(spark, d):
    """The rows that the same pass lets through."""
    return _checked(spark, d).rows


def q_restate_features(spark, d):
    """Two accounts of every fifth party restated: their features put over the stored ones."""
    paired = panel.pair_prev(fx.statements_flagged(spark, d, fx.staged_statements(spark, d)), _shifted(), list(ACCOUNT_CODES))
    stored = sinks.stage_panel(features.compute_features(paired, _cat()), bucket_by=KEYS)
    doubled = {c: F.col(c) * 2 for c in RESTATED}
    return restate.recompute(stored, paired.where(F.col(PARTY) % 5 == 0).withColumns(doubled), RESTATED, _cat())


QUERIES: dict[str, Query] = {
    "scan_statements_window": q_scan_statements_window,
    "map_columns": q_map_columns,
    "parse_dates": q_parse_dates,
    "restrict_to_spine": q_restrict_to_spine,
    "year_grid": q_year_grid,
    "pair_prev_flag": q_pair_prev_flag,
    "pair_prev_lag": q_pair_prev_lag,
    "normalize_multiply": q_normalize_multiply,
    "normalize_divide": q_normalize_divide,
    "agg_features": q_agg_features,
    "ratio_dc": _ratio_family("DC_"),
    "ratio_fs": _ratio_family("FS_"),
    "ratio_lq": _ratio_family("LQ_"),
    "ratio_prof": _ratio_family("PROF_"),
    "ratio_ef": _ratio_family("EF_"),
    "ratio_const": _ratio_family("CONST_"),
    "custom_flag": q_custom_flag,
    "custom_lag": q_custom_lag,
    "config_features": q_config_features,
    "attach_to_spine": q_attach_to_spine,
    "attach_prev_month_end": q_attach_prev_month_end,
    "month_grid": q_month_grid,
    "forward_fill": q_forward_fill,
    "null_audit": q_null_audit,
    "null_audit_month": q_null_audit_month,
    "filter_month": q_filter_month,
    "coverage_report": q_coverage_report,
    "compute_features": q_compute_features,
    "features_long": q_features_long,
    "panel_features": q_panel_features,
    "stage_panel": q_stage_panel,
    "read_statements": q_read_statements,
    "write_features": q_write_features,
    "write_table": q_write_table,
    "null_audit_all": q_null_audit_all,
    "coverage_report_unpaired": q_coverage_report_unpaired,
    "yearly_job": q_yearly_job,
    "pair_prev_flag_dirty": q_pair_prev_flag_dirty,
    "forward_fill_dup": q_forward_fill_dup,
    "map_columns_dirty": q_map_columns_dirty,
    "normalize_divide_dirty": q_normalize_divide_dirty,
    "attach_prev_month_end_dirty": q_attach_prev_month_end_dirty,
    "restrict_to_spine_filtered": q_restrict_to_spine_filtered,
    "flagship_filtered": q_flagship_filtered,
    "publish_features": q_publish_features,
    "publish_table": q_publish_table,
    "upsert_statements": q_upsert_statements,
    "pair_prev_stream": q_pair_prev_stream,
    "stage_reuse": q_stage_reuse,
    "scan_clustered": q_scan_clustered,
    "normalize_base_month": q_normalize_base_month,
    "extended_catalogue": q_extended_catalogue,
    "forward_fill_carry": q_forward_fill_carry,
    "forward_fill_carry_long": q_forward_fill_carry_long,
    "quarantine_rows": q_quarantine_rows,
    "quarantine_accepted": q_quarantine_accepted,
    "restate_features": q_restate_features,
    "flagship": q_flagship,
}
