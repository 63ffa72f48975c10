"""Spark SQL expression text for wide projections.

Building a ``Column`` costs a JVM round trip per operator; a catalogue of
hundreds of features is tens of thousands of them, seconds of driver time
per job.  The feature compiler therefore writes each expression as Spark SQL
text and hands a whole projection to ``selectExpr`` in one call; Spark's own
parser turns it into the same expression tree.  Binary operations are fully
parenthesised, so the tree (and the order of floating-point operations) is
exactly the one written.
"""

from __future__ import annotations

from collections.abc import Sequence


def ident(name: str) -> str:
    """Quoted column reference."""
    return "`" + name.replace("`", "``") + "`"


def _lit(x) -> str:
    if isinstance(x, Sql):
        return x.text
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, int):
        return str(x)
    if isinstance(x, float):
        return f"{x!r}D"
    raise TypeError(f"unsupported operand {x!r}")


class Sql:
    """An expression as SQL text, composable with ``+ - * /`` and unary ``-``."""

    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text

    def __str__(self) -> str:
        return self.text

    def __repr__(self) -> str:
        return f"Sql({self.text!r})"

    def _bin(self, op: str, other, reverse: bool = False) -> Sql:
        a, b = (_lit(other), self.text) if reverse else (self.text, _lit(other))
        return Sql(f"({a} {op} {b})")

    # Sums keep their written order (see ordered_add).
    def __add__(self, o): return ordered_add(self, Sql(_lit(o)))
    def __radd__(self, o): return ordered_add(Sql(_lit(o)), self)
    def __sub__(self, o): return self._bin("-", o)
    def __rsub__(self, o): return self._bin("-", o, True)
    def __mul__(self, o): return self._bin("*", o)
    def __rmul__(self, o): return self._bin("*", o, True)
    def __truediv__(self, o): return self._bin("/", o)
    def __rtruediv__(self, o): return self._bin("/", o, True)
    def __neg__(self): return Sql(f"(- {self.text})")


def col(name: str) -> Sql:
    return Sql(ident(name))


def coalesce0(x: str | Sql) -> Sql:
    x = col(x) if isinstance(x, str) else x
    return Sql(f"coalesce({x.text}, 0.0D)")


def ordered_add(a: Sql, b: Sql) -> Sql:
    """``a + b`` written ``a - (-b)``: the same IEEE result, but not reordered.

    Spark canonicalises addition as commutative when it eliminates common
    subexpressions, so two features summing the same accounts in different
    orders would share one evaluation and differ from their written order in
    the last bit.  Subtraction keeps its operand order.
    """
    return Sql(f"({a.text} - (- {b.text}))")


def zero_sum(cols: Sequence[str | Sql]) -> Sql | None:
    """Left-to-right sum with null read as 0; ``None`` for an empty list."""
    if not cols:
        return None
    acc = coalesce0(cols[0])
    for c in cols[1:]:
        acc = ordered_add(acc, coalesce0(c))
    return acc


def signed_sum(added: Sequence[str | Sql], subtracted: Sequence[str | Sql] = ()) -> Sql:
    """``sum(added) - sum(subtracted)``, null read as 0, never null."""
    pos, neg = zero_sum(added), zero_sum(subtracted)
    if pos is None and neg is None:
        return Sql("0.0D")
    if neg is None:
        return pos
    if pos is None:
        return Sql(f"(0.0D - {neg.text})")
    return Sql(f"({pos.text} - {neg.text})")


def safe_div(num: Sql, den: Sql) -> Sql:
    """``num / den``; null when ``den`` is null or zero, or when the quotient overflows to +-inf."""
    q = f"{num.text} / {den.text}"
    return Sql(f"CASE WHEN {den.text} IS NULL OR {den.text} = 0 THEN CAST(NULL AS DOUBLE) "
               f"WHEN abs({q}) = double('Infinity') THEN CAST(NULL AS DOUBLE) ELSE {q} END")


def missing_as_null(name: str) -> str:
    """Account column as double with NaN read as missing (null), as pandas-written inputs need."""
    return f"nanvl(TRY_CAST({ident(name)} AS DOUBLE), CAST(NULL AS DOUBLE)) AS {ident(name)}"


def alias(expr: Sql | str, name: str) -> str:
    return f"{expr if isinstance(expr, str) else expr.text} AS {ident(name)}"


def struct_of(cols: Sequence[str]) -> str:
    return "struct(" + ", ".join(ident(c) for c in cols) + ")"
