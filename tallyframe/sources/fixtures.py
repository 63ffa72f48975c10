"""Statement-shaped inputs derived from the TPC-H-style test tables.

The test data holds orders and line items, not financial statements, so each
input the feature operators read is derived by Spark from ``lineitem`` and
``orders``; its size grows with theirs.  Amounts are computed in integer
cents and converted to doubles once, so any engine gets the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.sqltext import ident
from tallyframe.sources.schema import ACCOUNT_CODES, DATE, FLAG, KEYS, PARTY, PHYSICAL_NAMES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _account_value(i: int) -> str:
    # Fixed values of the derivation rule: a null, a zero or an integer-cent amount.
    return (f"CASE WHEN (party_id * 7 + yr * 13 + {i}) % 11 = 0 THEN CAST(NULL AS DOUBLE) "
            f"WHEN (party_id + yr + {i}) % 17 = 0 THEN 0.0D "
            f"ELSE CAST((s * {101 + 2 * i} + q * {31 * i}) % 1000003 AS DOUBLE) / 100 END")


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One December statement per customer and order year; 57 account columns."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    led = (li.join(od, li.l_orderkey == od.o_orderkey)
             .groupBy(F.col("o_custkey").alias(PARTY), F.year("o_orderdate").cast("bigint").alias("yr"))
             .agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("s"),
                  F.sum(F.col("l_quantity").cast("bigint")).alias("q")))
    accounts = [f"{_account_value(i)} AS {ident(code)}" for i, code in enumerate(sorted(ACCOUNT_CODES), start=1)]
    return led.selectExpr(PARTY, f"make_date(CAST(yr AS INT), 12, 31) AS {DATE}", *accounts)


def staged_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`statements`, computed once and staged as Parquet in the shared checkpoint folder.

    For jobs that read the derived statements in several branches (spine and
    filings, model and source): the line-item join and aggregation run once,
    every branch reads the staged files (with column pruning: the spine reads
    only its keys), and a lost executor re-reads them instead of recomputing
    the join.
    """
    from tallyframe.sources.sinks import stage_panel

    return stage_panel(statements(spark, sf_dir))


def _next_year_end(d: Column) -> Column:
    return F.make_date(F.year(d) + 1, F.lit(12), F.lit(31))


def statements_flagged(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """Flag 0: each statement. Flag 1: the same figures re-dated to the next year end,
    as restated in the next filing (left out for parties divisible by 6).  The
    year after a party's last statement therefore has a flag-1 row only.

    Both flags come from one pass over the statements (each row expands to
    one or two rows), so the derivation is computed once."""
    st = statements(spark, sf_dir) if st is None else st
    values = [ident(c) for c in st.columns if c not in (PARTY, DATE)]
    expanded = st.selectExpr(PARTY, DATE, *values, f"explode(array(0, 1)) AS {FLAG}")
    return (expanded.where(f"{FLAG} = 0 OR {PARTY} % 6 != 0")
                    .selectExpr(PARTY, f"CASE WHEN {FLAG} = 0 THEN {DATE} "
                                       f"ELSE make_date(year({DATE}) + 1, 12, 31) END AS {DATE}",
                                *values, FLAG))


def _raw_name(code: str) -> str:
    """Physical name in mixed case: descriptive names title-cased, plain codes lower-cased."""
    return PHYSICAL_NAMES[code].title() if code in PHYSICAL_NAMES else code.lower()


# The raw table stores P_47 in two parts, mapped back with "p_47_main + p_47_adj".
SPLIT_CODE = "P_47"
SPLIT_PARTS = ("p_47_main", "p_47_adj")


def raw_mapping() -> dict[str, str]:
    """Code -> physical name for :func:`statements_raw` (mapping plus the split code)."""
    out = dict(PHYSICAL_NAMES)
    out[SPLIT_CODE] = " + ".join(SPLIT_PARTS)
    return out


def statements_raw(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """Flagged statements as a raw source table: physical names, text dates."""
    fl = statements_flagged(spark, sf_dir, st)
    cols = [f"{PARTY} AS Party_Id",
            f"CASE WHEN {PARTY} % 3 = 0 THEN date_format({DATE}, 'yyyyMMdd') "
            f"WHEN {PARTY} % 3 = 1 THEN date_format({DATE}, 'yyyy-MM-dd') "
            f"ELSE date_format({DATE}, 'dd.MM.yyyy') END AS DATA_DATE",
            f"{FLAG} AS Prev_Financial_Indicator"]
    for code in ACCOUNT_CODES:
        if code == SPLIT_CODE:
            cols += [f"{ident(code)} AS {SPLIT_PARTS[0]}", f"0.0D AS {SPLIT_PARTS[1]}"]
        else:
            cols.append(f"{ident(code)} AS {ident(_raw_name(code))}")
    return fl.selectExpr(*cols)


def statements_closing(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """Flagged statements keyed by a ``dd.MM.yyyy`` closing-date string."""
    fl = statements_flagged(spark, sf_dir, st)
    return fl.select(PARTY, F.date_format(DATE, "dd.MM.yyyy").alias("close_date"), FLAG, *ACCOUNT_CODES)


def spine(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """Keys of parties not divisible by 4: each statement's key and the next year end
    (a key without a statement where the party skipped or stopped filing)."""
    st = (statements(spark, sf_dir) if st is None else st).where(F.col(PARTY) % 4 != 0)
    keys = st.selectExpr(PARTY, f"explode(array({DATE}, make_date(year({DATE}) + 1, 12, 31))) AS {DATE}")
    return keys.dropDuplicates(list(KEYS))


def month_spine(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """(party_id, month_start text) for 1 January and 1 June after each statement."""
    st = (statements(spark, sf_dir) if st is None else st).select(PARTY, (F.year(DATE) + 1).alias("y"))
    months = F.array(F.make_date("y", F.lit(1), F.lit(1)).cast("string"),
                     F.make_date("y", F.lit(6), F.lit(1)).cast("string"))
    return st.select(PARTY, F.explode(months).alias("month_start"))


def inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly index with absent months and zero rates."""
    od = table(spark, sf_dir, "orders").select("o_orderdate")
    m = od.select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("ym"),
                  (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("idx")).distinct()
    return (m.where(F.col("idx") % 19 != 0)
             .select(F.col("ym").cast("int").alias("year_month"),
                     F.when(F.col("idx") % 23 == 0, F.lit(0.0))
                      .otherwise(1 + (F.col("idx") % 37).cast("double") / 100).alias("inflation_rate")))


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order totals per customer, with gaps and null values."""
    od = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    t = (od.groupBy(F.col("o_custkey").alias(PARTY), F.year("o_orderdate"), F.month("o_orderdate"))
           .agg(F.max("o_orderdate").cast("date").alias(DATE),
                F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("bigint").alias("cents"),
                F.count(F.lit(1)).alias("cnt")))
    pid, cnt = F.col(PARTY), F.col("cnt")
    return t.select(pid, DATE,
                    F.when((pid + cnt) % 3 == 0, F.lit(None)).otherwise(F.col("cents")).alias("amount_cents"),
                    F.when(pid % 5 == 0, F.lit(None)).otherwise(cnt).alias("n_orders"))


def audit_sides(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(model, source): two feature tables with overlapping keys and nulls.

    model = A_15 of every statement; source = A_17 of the flag-1 rows of
    parties not divisible by 5 (so some keys exist on one side only).
    """
    st = statements(spark, sf_dir) if st is None else st
    model = st.select(*KEYS, F.col("A_15").alias("feature_x"))
    fl = statements_flagged(spark, sf_dir, st)
    source = (fl.where((F.col(FLAG) == 1) & (F.col(PARTY) % 5 != 0))
                .select(*KEYS, F.col("A_17").alias("raw_feature")))
    return model, source


# Dirty variants: repeated rows, null and malformed keys, bad rates and months.
def flagged_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two accounts; parties divisible by 7 lose their dates, those divisible by 5 have each row twice (A_1 + 1)."""
    fl = statements_flagged(spark, sf_dir).select(PARTY, DATE, FLAG, "A_1", "P_3")
    undated = fl.withColumn(DATE, F.when(F.col(PARTY) % 7 != 0, F.col(DATE)))
    return undated.unionByName(fl.where(F.col(PARTY) % 5 == 0).withColumn("A_1", F.col("A_1") + 1))


def sparse_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second row a month (100 cents more) for parties divisible by 3; rows without party."""
    sp = sparse(spark, sf_dir)
    again = (sp.where(F.col(PARTY) % 3 == 0).withColumn(DATE, F.trunc(DATE, "month"))
               .withColumn("amount_cents", F.col("amount_cents") + 100))
    lost = sp.where(F.col(PARTY) % 11 == 0).withColumn(PARTY, F.lit(None).cast(sp.schema[PARTY].dataType))
    return sp.unionByName(again).unionByName(lost)


def raw_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table with text keys, some of them malformed or null."""
    pid = F.col("Party_Id")
    return statements_raw(spark, sf_dir).withColumns({
        "Party_Id": F.when(pid % 10 == 3, F.concat(pid.cast("string"), F.lit("x"))).when(pid % 10 != 4, pid.cast("string")),
        "DATA_DATE": F.when(pid % 4 == 1, "bad").otherwise(F.col("DATA_DATE")),
        "Prev_Financial_Indicator": F.when(pid % 9 == 2, "n/a").otherwise(F.col("Prev_Financial_Indicator").cast("string"))})


def inflation_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index with NaN rates and rows of months that do not exist."""
    idx = inflation(spark, sf_dir)
    nan = idx.withColumn("inflation_rate", F.when(F.col("year_month") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("inflation_rate")))
    return nan.unionByName(idx.withColumn("year_month", F.col("year_month") * 100 + 77))


def month_spine_dirty(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """The month spine with text parties, some malformed, some of 17 digits."""
    pid = F.col(PARTY)
    return month_spine(spark, sf_dir, st).withColumn(
        PARTY, F.when(pid % 10 == 3, F.concat(pid.cast("string"), F.lit("x")))
                .when(pid % 10 == 4, F.concat(F.lit("1234567890"), F.lpad(pid.cast("string"), 7, "0")))
                .otherwise(pid.cast("string")))
