"""Numeric helpers: tolerant amounts/integers and exact rounded ratios.

Ratios are computed from exact integer numerators and denominators and rounded
half away from zero with integer arithmetic, so a result never depends on the
order in which partial sums were combined across partitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import ColumnOrName, _as_text, _c, _ident, _text_sql

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def amount(c: ColumnOrName, default: int | float | None = 0) -> Column:
    """NULL or '' -> default; otherwise a *strict* cast to decimal(18,2).

    Under ANSI mode non-numeric text raises instead of silently becoming NULL.
    """
    if isinstance(c, str):
        parsed = (f"case when {_ident(c)} is null or {_text_sql(c)} = '' then cast(null as {MONEY}) "
                  f"else cast({_ident(c)} as {MONEY}) end")
        return F.expr(parsed if default is None else f"coalesce({parsed}, cast({default!r} as {MONEY}))")
    raw = _c(c)
    parsed = F.when(raw.isNull() | (_as_text(raw) == ""), F.lit(None).cast(MONEY)).otherwise(raw.cast(MONEY))
    if default is None:
        return parsed
    return F.coalesce(parsed, F.lit(default).cast(MONEY))


def int_or_null(c: ColumnOrName) -> Column:
    """NULL or '' -> NULL; otherwise a strict integer cast."""
    if isinstance(c, str):
        return F.expr(f"case when {_ident(c)} is null or {_text_sql(c)} = '' then cast(null as int) "
                      f"else cast({_ident(c)} as int) end")
    raw = _c(c)
    return F.when(raw.isNull() | (_as_text(raw) == ""), F.lit(None).cast("int")).otherwise(raw.cast("int"))


def int_default(c: ColumnOrName, default: int = 0) -> Column:
    return F.coalesce(int_or_null(c), F.lit(default))


def cents(c: ColumnOrName) -> Column:
    """Exact unscaled value of a 2-decimal money column as bigint."""
    return (_c(c) * 100).cast("bigint")


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """``round(num / den, digits)`` half away from zero; NULL when den is 0/NULL.

    ``num`` and ``den`` must be exact integers (use :func:`cents` for money).
    The quotient is taken with integral division on decimal(38,0), so there
    is no floating point anywhere before the final scaling.
    """
    scale = 10**digits
    n = F.abs(num).cast("decimal(38,0)")
    d = F.abs(den).cast("decimal(38,0)")
    q = F.call_function("div", n * F.lit(2 * scale) + d, d * F.lit(2))
    sign = (F.signum(num) * F.signum(den)).cast("bigint")
    return F.when(den.isNull() | (den == 0), F.lit(None).cast("double")).otherwise((q * sign) / F.lit(scale))


def ratio_sql(num: str, den: str, digits: int) -> str:
    """SQL text of :func:`round_ratio` for SQL-text operands (one JVM call to build)."""
    scale = 10**digits
    n = f"cast(abs({num}) as decimal(38,0))"
    d = f"cast(abs({den}) as decimal(38,0))"
    return (f"case when ({den}) is null or ({den}) = 0 then cast(null as double) else "
            f"(({n} * {2 * scale} + {d}) div ({d} * 2)) * cast(signum({num}) * signum({den}) as bigint) / {scale} end")


def ratio_expr(num: str, den: str, digits: int, guard: str | None = None) -> Column:
    """``round(num/den, digits)`` from SQL-text operands; with ``guard`` the result
    is the ratio when the guard holds and 0 otherwise."""
    r = ratio_sql(num, den, digits)
    return F.expr(r if guard is None else f"case when {guard} then {r} else 0.0 end")


def cents_sql(x: str) -> str:
    return f"cast({x} * 100 as bigint)"


def guarded_ratio(num: Column, den: Column, digits: int) -> Column:
    """``case when den > 0 then round(num/den, digits) else 0 end``."""
    return F.when(den > 0, round_ratio(num, den, digits)).otherwise(F.lit(0.0))


def round_money(c: ColumnOrName) -> Column:
    return _c(c).cast(MONEY_SUM)


def sum_money(c: ColumnOrName) -> Column:
    """Exact sum of a 2-decimal money column, accumulated as integer cents.

    A decimal(18,2) sum buffer is decimal(28,2), which Spark evaluates with
    ``java.math.BigDecimal``; a bigint buffer stays on the fast primitive
    path (and ANSI mode raises instead of wrapping on overflow).
    """
    return from_cents(F.sum(cents(c)))


def from_cents(c: Column) -> Column:
    """bigint cents -> decimal(38,2), exactly."""
    return (c.cast("decimal(38,0)") / 100).cast(MONEY_SUM)
