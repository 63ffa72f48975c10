"""Custom ratios: hand-written formulas over this year's and last year's accounts.

A formula is a function ``fn(c, p) -> (numerator, denominator)`` where
``c(code)`` is this year's amount and ``p(code)`` last year's.  The value is
``safe_div(numerator, denominator)``.  Unlike aggregates, nulls propagate:
any missing operand makes the feature null.

Formulas are evaluated through an accessor, so the same definition yields
Spark ``Column`` objects (:func:`formula_column`) and the exact list of
columns it reads (:func:`formula_inputs`); dependencies are never kept by
hand.  Register more with :func:`register_formula`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions import sqltext
from tallyframe.functions.sqltext import Sql

PREV_SUFFIX = "_prev"

Formula = Callable[[Callable[[str], Sql], Callable[[str], Sql]], tuple[Sql, Sql]]

_REGISTRY: dict[str, Formula] = {}


def register_formula(name: str, fn: Formula) -> Formula:
    """Add or replace the formula used for custom ratio ``name``.

    ``fn(c, p)`` returns ``(numerator, denominator)`` built with ``+ - * /``
    from ``c(code)`` (this year) and ``p(code)`` (last year) and numbers.
    """
    _REGISTRY[name] = fn
    return fn


def formula(name: str) -> Formula:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"no formula registered for custom ratio {name!r}") from None


def registered_formulas() -> list[str]:
    return list(_REGISTRY)


def prev_name(code: str) -> str:
    return f"{code}{PREV_SUFFIX}"


def formula_sql(name: str, cur: Callable[[str], Sql] | None = None,
                prev: Callable[[str], Sql] | None = None) -> Sql:
    """Expression text of custom ratio ``name`` over columns ``code`` / ``code_prev``."""
    return sqltext.safe_div(*formula_parts(name, cur, prev))


def formula_parts(name: str, cur: Callable[[str], Sql] | None = None,
                  prev: Callable[[str], Sql] | None = None) -> tuple[Sql, Sql]:
    """(numerator, denominator) of custom ratio ``name``; plain numbers become literals."""
    num, den = formula(name)(cur or sqltext.col, prev or (lambda code: sqltext.col(prev_name(code))))
    return tuple(x if isinstance(x, Sql) else Sql(f"{float(x)!r}D") for x in (num, den))


def formula_column(name: str) -> Column:
    """Spark ``Column`` of custom ratio ``name`` (one JVM call)."""
    return F.expr(formula_sql(name).text)


def formula_inputs(name: str) -> tuple[list[str], list[str]]:
    """(current codes, previous-year codes) read by the formula, first-use order."""
    cur_seen: dict[str, None] = {}
    prev_seen: dict[str, None] = {}

    def cur(code: str) -> Sql:
        cur_seen.setdefault(code)
        return sqltext.col(code)

    def prev(code: str) -> Sql:
        prev_seen.setdefault(code)
        return sqltext.col(prev_name(code))

    formula(name)(cur, prev)
    return list(cur_seen), list(prev_seen)


def _register(name: str):
    def deco(fn: Formula) -> Formula:
        return register_formula(name, fn)
    return deco


# The 41 custom ratio formulas. Operand order is kept as defined, so
# that doubles match any engine evaluating the same arithmetic. Two operands are
# corrected on purpose: DC_31 reads P_331 (the catalogue requires it; P_31 is not
# an account) and EF_13 reads G_60 (the catalogue requires it; G_0 is not an account).
# CONST_11 is declared with Amortisman_ve_Itfa_Giderleri but its formula omits it;
# that is kept as given.
AMORT = "Amortisman_ve_Itfa_Giderleri"


@_register("DC_31")
def _dc_31(c, p):
    num = (c("G_692") + c("G_66") + c("G_691") + c(AMORT)
           + p("G_692") + p("G_66") + p("G_691") + p(AMORT)) / 2
    return num, c("P_3") - c("P_331")


@_register("EF_13")
def _ef_13(c, p):
    return c("G_60") + c("A_15") - p("A_15"), c("A_15")


@_register("EF_14")
def _ef_14(c, p):
    return (c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612"))
            + c("A_15") - p("A_15")), c("A_15")


@_register("EF_17")
def _ef_17(c, p):
    return 365 * (c("A_15") + p("A_15")) / 2, c("G_62")


@_register("EF_19")
def _ef_19(c, p):
    return 365 * ((c("P_32") + c("P_42") + p("P_32") + p("P_42")) / 2), c("G_62")


@_register("EF_20")
def _ef_20(c, p):
    return (365 * ((c("A_12") + c("A_22") + p("A_12") + p("A_22")) / 2),
            c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612")))


@_register("FS_12")
def _fs_12(c, p):
    return c("P_30") - p("P_30") + c("P_40") - p("P_40"), c("A_1") + c("A_2")


@_register("FS_53_CONT")
def _fs_53_cont(c, p):
    num = (c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612"))
           + c("P_35") + p("P_35")) / 2 + c("P_34")
    den = (c("A_17") + p("A_17")) / 2 + c("A_15") + c("G_62")
    return num, den


@_register("FS_55_CONT")
def _fs_55_cont(c, p):
    return (c("P_35") + p("P_35")) / 2, (c("A_17") + p("A_17")) / 2


@_register("FS_56_CONT")
def _fs_56_cont(c, p):
    num = (c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612"))
           + p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612"))
           + c("P_35") + p("P_35")) / 2
    den = (c("A_17") + p("A_17") + c("G_62") + p("G_62")) / 2
    return num, den


@_register("LQ_13")
def _lq_13(c, p):
    return c("A_1") - c("P_3"), c("G_60") + c("A_15") - p("A_15")


@_register("LQ_14")
def _lq_14(c, p):
    return (c("A_1") - c("P_3"),
            c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612"))
            + c("A_15") - p("A_15"))


@_register("LQ_50")
def _lq_50(c, p):
    return (c("A_12") + c("A_10") + c("A_11") + (c("A_15") + p("A_15")) / 2,
            c("P_3") - c("P_331"))


@_register("PROF_32")
def _prof_32(c, p):
    return (c("G_692") + c("G_66") + c("G_691") + c(AMORT) - (c("A_25") - p("A_25") + c(AMORT)),
            c("G_66") - c("G_642"))


@_register("PROF_33")
def _prof_33(c, p):
    return (c("G_692") + c("G_66") + c("G_691") + c(AMORT) - (c("A_25") - p("A_25") + c(AMORT)),
            c("P_30") + c("P_40") + c("G_66") - c("A_10"))


def _growth(code: str) -> Formula:
    """Year-over-year change of one account: (x - x_prev) / x_prev."""
    return lambda c, p: (c(code) - p(code), p(code))


for _name, _code in (("TR_01", "G_60"), ("TR_04", "G_692"), ("TR_06", "P_5"), ("TR_07", "P_3"),
                     ("TR_12", "P_4"), ("TR_13", "A_25"), ("TR_14", "A_2"), ("TR_18", "P_30"),
                     ("TR_19", "P_40")):
    register_formula(_name, _growth(_code))


@_register("TR_05")
def _tr_05(c, p):
    return (c("G_692") + c("G_66") + c("G_691") + c(AMORT)
            - (p("G_692") + p("G_66") + p("G_691") + p(AMORT)),
            p("G_692") + p("G_66") + p("G_691") + p(AMORT))


@_register("TR_08")
def _tr_08(c, p):
    num = (c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612")) + c("G_62")
           - (p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612")) + p("G_62")))
    den = p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612")) + p("G_62")
    return num, den


@_register("TR_09")
def _tr_09(c, p):
    num = (c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612"))
           - (p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612"))))
    den = p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612"))
    return num, den


@_register("TR_10")
def _tr_10(c, p):
    return c("A_1") + c("A_2") - (p("A_1") + p("A_2")), p("A_1") + p("A_2")


@_register("TR_11")
def _tr_11(c, p):
    return c("A_1") + c("P_3") - (p("A_1") + p("P_3")), p("A_1") + p("P_3")


@_register("TR_15")
def _tr_15(c, p):
    num = (c("A_12") - (c("G_600") + c("G_601") + c("G_602") - (c("G_610") + c("G_611") + c("G_612")))
           - (p("A_12") - (p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612")))))
    den = p("A_12") - (p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612")))
    return num, den


@_register("TR_17")
def _tr_17(c, p):
    return c("P_30") + c("P_40") - (p("P_30") + p("P_40")), p("P_30") + p("P_40")


def _const_cash(c, p):
    """Shared numerator head of CONST_06/07/09/17/18/20/22."""
    return c("P_35") - c("A_17") - (p("P_35") - p("A_17")) + c("G_692") + c("G_66") + c("G_691") + c(AMORT)


def _const_cash_sales(c, p):
    """Shared numerator head of CONST_17/18/20/22."""
    return (_const_cash(c, p) + c("G_600") + c("G_601") + c("G_602")
            - (c("G_610") + c("G_611") + c("G_612"))
            - (p("G_600") + p("G_601") + p("G_602") - (p("G_610") + p("G_611") + p("G_612"))))


@_register("CONST_06")
def _const_06(c, p):
    return _const_cash(c, p), c("G_66")


@_register("CONST_07")
def _const_07(c, p):
    return (_const_cash(c, p) - (c("A_12") - p("A_12")) + (c("P_32") - p("P_32")),
            c("P_30") + c("G_66"))


@_register("CONST_09")
def _const_09(c, p):
    return _const_cash(c, p), c("P_3") + c("P_40") + c("P_42") + c("P_43")


@_register("CONST_11")
def _const_11(c, p):
    return (c("P_35") - c("A_17") - (p("P_35") - p("A_17")) + c("G_692") + c("G_66") + c("G_691"),
            c("P_3") + c("P_40") + c("P_42") + c("P_43") - c("P_35"))


@_register("CONST_17")
def _const_17(c, p):
    return _const_cash_sales(c, p), c("G_66")


@_register("CONST_18")
def _const_18(c, p):
    return (_const_cash_sales(c, p) - (c("A_12") - p("A_12")) + (c("P_32") - p("P_32")),
            c("P_30") + c("G_66"))


@_register("CONST_20")
def _const_20(c, p):
    return _const_cash_sales(c, p), c("P_3") + c("P_40") + c("P_42") + c("P_43")


@_register("CONST_22")
def _const_22(c, p):
    return _const_cash_sales(c, p), c("P_3") + c("P_40") + c("P_42") + c("P_43") - c("P_35")


@_register("CONST_FS_12")
def _const_fs_12(c, p):
    return c("P_30") - p("P_30") + c("P_40") - p("P_40"), c("A_1") + c("A_2") - c("A_17")


@_register("CONST_TR_02")
def _const_tr_02(c, p):
    return (c("A_1") + c("A_2") - c("A_17") - (p("A_1") + p("A_2") - p("A_17")),
            p("A_1") + p("A_2") - p("A_17"))
