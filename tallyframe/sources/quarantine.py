"""Raw statement rows with values that can't be read: counted and set aside in the pass that reads the others.

``map_columns`` turns a malformed key, date, flag or amount into null, which looks like one that was never
there.  ``checked_columns`` does the same and names the columns of each row whose raw value was there but
could not be read.  ``write_checked`` writes both kinds in one job, a scan of the raw table: the rows
that can be used (the others' amounts stay null, as ``map_columns`` has them) and, beside them, the raw
text of every row with a malformed value; counts per column are observed on the way.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyframe.functions.sqltext import ident
from tallyframe.sources.readers import date_sql, map_columns, resolve_columns
from tallyframe.sources.schema import DATE, FLAG, PARTY

BAD, RAW = "malformed", "raw_row"


def _readable(raw: str, canonical: str, parse_dates: bool) -> str:
    """SQL that is null where ``raw`` can't be read as the canonical column."""
    if canonical == PARTY:
        return f"TRY_CAST({ident(raw)} AS BIGINT)"
    if canonical == DATE:
        return date_sql(ident(raw)) if parse_dates else f"TRY_CAST({ident(raw)} AS DATE)"
    if canonical == FLAG:
        return f"TRY_CAST({ident(raw)} AS INT)"
    return f"TRY_CAST({ident(raw)} AS DOUBLE)"


def _sources(df: DataFrame, accounts: Iterable[str], mapping: Mapping[str, str] | None, keys: Mapping[str, str] | None) -> dict[str, list[str]]:
    """Canonical column -> physical columns it is read from."""
    lookup = {c.lower(): c for c in df.columns}
    keys = dict(keys or {PARTY: PARTY, DATE: DATE, FLAG: FLAG})
    out = {k: [lookup[phys.lower()]] for k, phys in keys.items() if phys.lower() in lookup}
    found, _ = resolve_columns(df.columns, accounts, mapping)
    out.update({code: [p.strip() for p in found[code].split(" + ")] for code in sorted(found)})
    return out


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _always_readable(kind: str, canonical: str) -> bool:
    """Whether every value of this type can be read as the canonical column, so that there is nothing to test."""
    if canonical == PARTY:
        return kind in _WHOLE
    if canonical == DATE:
        return kind == "date"
    if canonical == FLAG:
        return kind in _WHOLE[:3]
    return kind in (*_WHOLE, "float", "double") or kind.startswith("decimal")


def _tests(df: DataFrame, accounts: Iterable[str], mapping: Mapping[str, str] | None, keys: Mapping[str, str] | None,
           parse_dates: bool) -> dict[str, str]:
    """Canonical column -> SQL that is true for a malformed value; only the columns whose types leave room for one."""
    types = dict(df.dtypes)
    tests = {}
    for canonical, raws in _sources(df, accounts, mapping, keys).items():
        bad = []
        for raw in raws:
            if _always_readable(types[raw], canonical):
                continue
            # A number or date in its own type is as it should be; text has to be parsed.
            there = f"trim({ident(raw)}) <> ''" if types[raw] == "string" else f"{ident(raw)} IS NOT NULL"
            bad.append(f"({there} AND {_readable(raw, canonical, parse_dates and types[raw] == 'string')} IS NULL)")
        if bad:
            tests[canonical] = " OR ".join(bad)
    return tests


def malformed(df: DataFrame, accounts: Iterable[str], mapping: Mapping[str, str] | None = None,
              keys: Mapping[str, str] | None = None, parse_dates: bool = True) -> Column:
    """Names of the canonical columns whose raw value is there (blank text is not) and can't be read, in column order."""
    names = [f"CASE WHEN {bad} THEN '{canonical}' END" for canonical, bad in _tests(df, accounts, mapping, keys, parse_dates).items()]
    if not names:
        return F.expr("CAST(array() AS ARRAY<STRING>)")
    # Generated code; array_compact is interpreted, with every test in it.
    return F.expr(f"array_except(array({', '.join(names)}), array(CAST(NULL AS STRING)))")


def checked_columns(df: DataFrame, accounts: Sequence[str], mapping: Mapping[str, str] | None = None,
                    keys: Mapping[str, str] | None = None, parse_dates: bool = True) -> DataFrame:
    """``map_columns`` with ``malformed`` and, for rows that have such values, ``raw_row``: the raw row as JSON."""
    raw = df.select("*", malformed(df, accounts, mapping, keys, parse_dates).alias(BAD))
    text = F.when(F.size(BAD) > 0, F.to_json(F.struct(*(F.col(ident(c)) for c in df.columns)), {"ignoreNullFields": "false"}))
    both = raw.withColumn(RAW, text)
    # map_columns reads physical columns by name and ends in a projection; the two extra columns go round it as a struct.
    mapped = map_columns(df, accounts, mapping, keys, parse_dates)
    exprs = _projection(df, accounts, mapping, keys, parse_dates)
    return both.selectExpr(*exprs, BAD, RAW).select(*(F.col(ident(c)) for c in mapped.columns), BAD, RAW)


def _projection(df: DataFrame, accounts: Sequence[str], mapping, keys, parse_dates: bool) -> list[str]:
    from tallyframe.sources.readers import _physical_expr

    out = []
    for canonical, raws in _sources(df, accounts, mapping, keys).items():
        sql = (_readable(raws[0], canonical, parse_dates) if canonical in (PARTY, DATE, FLAG) else _physical_expr(" + ".join(raws)))
        out.append(f"{sql} AS {ident(canonical)}")
    return out


@dataclass
class Checked:
    """What a checked write left: the rows to use, the rejected ones, and how many values of each column were malformed."""

    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def write_checked(df: DataFrame, root: str, accounts: Sequence[str], mapping: Mapping[str, str] | None = None,
                  keys: Mapping[str, str] | None = None, parse_dates: bool = True, strict: bool = False) -> Checked:
    """Read, check and write in one job.

    A row with a malformed key, date or flag is only in ``rejected``; one with malformed amounts is in both (its
    amounts null), or with ``strict`` only in ``rejected``.
    """
    spark = df.sparkSession
    rows = checked_columns(df, accounts, mapping, keys, parse_dates)
    columns = [c for c in rows.columns if c not in (BAD, RAW)]
    watch = Observation()
    # Observed sums are interpreted, row by row: only the columns that can be malformed have one, the others' count is 0.
    per_column = [F.sum(F.array_contains(BAD, c).cast("long")).alias(c) for c in _tests(df, accounts, mapping, keys, parse_dates)]
    seen = rows.observe(watch, F.count(F.lit(1)).alias("rows"), F.sum((F.size(BAD) > 0).cast("long")).alias("rows with malformed values"), *per_column)
    key_bad = F.arrays_overlap(BAD, F.array(F.lit(PARTY), F.lit(DATE), F.lit(FLAG)))
    barred = F.size(BAD) > 0 if strict else key_bad
    kinds = F.when(F.size(BAD) == 0, F.array(F.lit("rows"))).when(barred, F.array(F.lit("rejected"))).otherwise(F.array(F.lit("rows"), F.lit("rejected")))
    (seen.select("*", F.explode(kinds).alias("kind"))
         # Each kind has what the other has not as null: Parquet stores that in next to nothing.
         .select(*(F.when(F.col("kind") == "rows", F.col(ident(c))).alias(c) for c in columns),
                 *(F.when(F.col("kind") == "rejected", F.col(c)).alias(c) for c in (BAD, RAW)), "kind")
         .write.mode("error").partitionBy("kind").parquet(root))
    written = spark.read.schema(rows.schema.add("kind", "string")).parquet(root)
    found = watch.get
    counts = {k: int(found.get(k) or 0) for k in ("rows", "rows with malformed values", *columns)}
    return Checked(written.where("kind = 'rows'").select(*(F.col(ident(c)) for c in columns)),
                   written.where("kind = 'rejected'").select(BAD, RAW), counts)
