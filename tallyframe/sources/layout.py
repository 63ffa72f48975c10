"""A statement table laid out for window scans: clustered by closing month and party, with statistics of its files.

``ClusteredStatements.write`` range-partitions the rows by (closing month, party), so every file
holds a short stretch of months, and of parties within a month, and sorts them within
files, so row groups do too.  Beside the files it keeps one row of statistics a file (first and last
date and party, rows).  ``scan`` asks for the closing month of every year of a window:

* the months become date ranges, which Parquet can test, instead of ``month(d) = 12``, which it can't;
* files whose dates or parties miss all ranges are not opened, by the statistics;
* in the others the ranges skip row groups (pushed-down filter), and the same condition removes single rows.

A write publishes a new generation (see :mod:`.published`), so a scan never sees half of one.
"""

from __future__ import annotations

import calendar
import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.sources.published import DATA, VersionLog
from tallyframe.sources.schema import CLOSING_MONTH, DATE, KEYS, LOOKBACK_MONTHS

STATS = "stats"


def months_back(day: dt.date, months: int) -> dt.date:
    """The same day ``months`` earlier, or the month's last one."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def closing_ranges(min_date: str | dt.date, max_date: str | dt.date, lookback_months: int = LOOKBACK_MONTHS,
                   month: int | None = CLOSING_MONTH) -> list[tuple[dt.date, dt.date]]:
    """First and last day of ``month`` in every year of [min_date - lookback_months, max_date], cut at the window's ends.

    Without a month, the window itself; nothing for an empty window.
    """
    low, high = (d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in (min_date, max_date))
    low = months_back(low, lookback_months)
    if month is None:
        return [(low, high)] if low <= high else []
    whole = ((dt.date(y, month, 1), dt.date(y, month, calendar.monthrange(y, month)[1])) for y in range(low.year, high.year + 1))
    return [(max(a, low), min(b, high)) for a, b in whole if max(a, low) <= min(b, high)]


def in_ranges(date: Column, ranges: Sequence[tuple[dt.date, dt.date]]) -> Column:
    """Whether a date lies in one of the ranges; plain comparisons that a scan can push down."""
    return reduce(lambda a, b: a | b, ((date >= F.lit(a)) & (date <= F.lit(b)) for a, b in ranges), F.lit(False))


def scan_closing_months(df: DataFrame, min_date: str, max_date: str, date_col: str = DATE,
                        lookback_months: int = LOOKBACK_MONTHS, month: int | None = CLOSING_MONTH) -> DataFrame:
    """The rows of :func:`tallyframe.sources.readers.scan_statements_window`, asked for by date ranges.

    For date columns; a timestamp counts to its window's last day at midnight only.
    """
    return df.where(in_ranges(F.col(date_col), closing_ranges(min_date, max_date, lookback_months, month)))


class ClusteredStatements:
    """Statements under ``root`` by closing month and party."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = KEYS):
        self.spark, self.root = spark, root.rstrip("/")
        self.party, self.date = keys
        self.log = VersionLog(spark, root)

    def write(self, df: DataFrame, files: int | None = None, row_group_bytes: int | None = None) -> int:
        """Replace the table; ``files`` is how many stretches to cut it into (default: the shuffle partitions)."""
        before, _ = self.log.latest()
        generation = f"{DATA}/{uuid.uuid4().hex}"
        order = [F.trunc(self.date, "month"), F.col(self.party)]
        laid = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
        writer = laid.sortWithinPartitions(*order, self.date).write.mode("error")
        if row_group_bytes:
            writer = writer.option("parquet.block.size", row_group_bytes)
        writer.parquet(f"{self.root}/{generation}/rows")
        rows = self.spark.read.schema(df.schema).parquet(f"{self.root}/{generation}/rows")
        date, party = F.col(self.date), F.col(self.party)
        stats = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(date).alias("first_date"), F.max(date).alias("last_date"),
            F.min(party).alias("first_party"), F.max(party).alias("last_party"), F.count(F.lit(1)).alias("rows"))
        stats.coalesce(1).write.mode("error").parquet(f"{self.root}/{generation}/{STATS}")
        return self.log.commit({"generation": generation, "schema": df.schema.json()}, before)

    def _latest(self) -> tuple[str, StructType]:
        import json

        found = self.log.latest()[1]
        if found is None:
            raise FileNotFoundError(f"{self.root}: nothing has been published")
        return f"{self.root}/{found['generation']}", StructType.fromJson(json.loads(found["schema"]))

    def stats(self) -> DataFrame:
        """One row a file: file, first and last date and party, rows."""
        return self.spark.read.parquet(f"{self._latest()[0]}/{STATS}")

    def files(self, ranges: Sequence[tuple[dt.date, dt.date]], parties: tuple | None = None) -> list[str]:
        """Files that may hold dates of ``ranges`` (and parties from ``parties[0]`` to ``parties[1]``): the scan's file list."""
        touch = reduce(lambda a, b: a | b, ((F.col("first_date") <= F.lit(b)) & (F.col("last_date") >= F.lit(a)) for a, b in ranges),
                       F.lit(False))
        if parties is not None:
            touch = touch & (F.col("first_party") <= F.lit(parties[1])) & (F.col("last_party") >= F.lit(parties[0]))
        return sorted(r["file"] for r in self.stats().where(touch).select("file").collect())

    def scan(self, min_date: str, max_date: str, lookback_months: int = LOOKBACK_MONTHS, month: int | None = CLOSING_MONTH,
             parties: tuple | None = None) -> DataFrame:
        """Statements of the closing months of the window, from the files and row groups that can have some."""
        where, schema = self._latest()
        ranges = closing_ranges(min_date, max_date, lookback_months, month)
        names = self.files(ranges, parties) if ranges else []
        if not names:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*(f"{where}/rows/{n}" for n in names)).where(in_ranges(F.col(self.date), ranges))
        return rows if parties is None else rows.where(F.col(self.party).between(*parties))
