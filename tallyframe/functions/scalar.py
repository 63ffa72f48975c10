"""Scalar Column helpers shared by every operator.

All helpers return built-in Catalyst expressions, so they stay inside
whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions import sqltext


def null_double() -> Column:
    return F.lit(None).cast("double")


# The three date layouts accepted for statement dates, tried in this order.
DATE_FORMATS = ("yyyyMMdd", "yyyy-MM-dd", "dd.MM.yyyy")


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def signed_sum(added: Sequence[str], subtracted: Sequence[str] = ()) -> Column:
    """``sum(added) - sum(subtracted)`` over account columns, null read as 0; never null.

    Operands are folded left to right in the given order (see
    :func:`tallyframe.functions.sqltext.signed_sum`), so doubles are bit-identical
    to a SQL engine evaluating the same text.
    """
    return F.expr(sqltext.signed_sum(list(added), list(subtracted)).text)


def parse_date_any(c: str | Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """First layout that parses wins; unparseable text gives null, not an error."""
    c = as_col(c)
    return F.coalesce(*[F.try_to_date(c, fmt) for fmt in formats])


def year_month(d: str | Column, months_back: int = 0) -> Column:
    """``yyyyMM`` integer of ``d`` shifted back by ``months_back`` months.

    Arithmetic on year and month instead of a ``date_format`` string round
    trip; ``add_months`` clamps to month end the same way ``last_day`` would.
    """
    d = as_col(d)
    if months_back:
        d = F.add_months(d, -months_back)
    return F.year(d) * 100 + F.month(d)


def month_index(d: str | Column) -> Column:
    """Months since year 0: consecutive calendar months differ by exactly 1."""
    d = as_col(d)
    return F.year(d) * 12 + F.month(d) - 1


def month_from_index(i: str | Column) -> Column:
    """Inverse of :func:`month_index`: first day of that month."""
    i = as_col(i)
    return F.make_date(F.floor(i / 12).cast("int"), (i % 12 + 1).cast("int"), F.lit(1))


def month_bounds(month: str) -> tuple[str, str]:
    """``"2020-06"`` -> (``"2020-06-01"``, ``"2020-07-01"``): a half-open range."""
    year, mon = (int(x) for x in month.split("-"))
    nxt = (year + mon // 12, mon % 12 + 1)
    return f"{year:04d}-{mon:02d}-01", f"{nxt[0]:04d}-{nxt[1]:02d}-01"
