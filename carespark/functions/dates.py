"""Date helpers: tolerant parsing, boundary-counting differences, calendar parts.

All helpers are plain Column expressions.  Dates are ``DateType``; wall-clock
timestamps are ``TimestampNTZType`` so results never depend on the session
time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import ColumnOrName, _as_text, _c, _text_sql


def as_date(d: _dt.date | str | Column) -> Column:
    """Literal date (or pass-through Column)."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def ntz_lit(value) -> Column:
    """Zone-less timestamp literal from a datetime or ISO text.

    Built from text, so the value never passes through the Python process's
    or the session's time zone.
    """
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_date(c: ColumnOrName) -> Column:
    """Tolerant date parse.

    NULL, blank and ``'0'`` give NULL.  Exactly eight characters are parsed as
    ``yyyyMMdd`` only (so ``'2024-1-5'`` is NULL).  Other lengths try ISO
    ``yyyy-MM-dd``, then ``dd-MMM-yyyy``, then ``MM/dd/yyyy``.  Anything
    unparsable is NULL, never an error.
    """
    if isinstance(c, str):
        t = f"trim({_text_sql(c)})"
        return F.expr(
            f"case when {t} is null or {t} = '' or {t} = '0' then cast(null as date) "
            f"when length({t}) = 8 then try_to_date({t}, 'yyyyMMdd') "
            f"else coalesce(try_to_date({t}, 'yyyy-MM-dd'), try_to_date({t}, 'dd-MMM-yyyy'), "
            f"try_to_date({t}, 'MM/dd/yyyy')) end")
    t = F.trim(_as_text(c))
    other = F.coalesce(
        F.try_to_date(t, "yyyy-MM-dd"),
        F.try_to_date(t, "dd-MMM-yyyy"),
        F.try_to_date(t, "MM/dd/yyyy"),
    )
    return (
        F.when(t.isNull() | (t == "") | (t == "0"), F.lit(None).cast("date"))
        .when(F.length(t) == 8, F.try_to_date(t, "yyyyMMdd"))
        .otherwise(other)
    )


def parse_datetime(c: ColumnOrName) -> Column:
    """Tolerant timestamp parse to a zone-less timestamp; blank/unparsable -> NULL."""
    if isinstance(c, str):
        t = f"trim({_text_sql(c)})"
        return F.expr(f"case when {t} = '' then cast(null as timestamp_ntz) else try_cast({t} as timestamp_ntz) end")
    t = F.trim(_as_text(c))
    return F.when(t == "", F.lit(None).cast("timestamp_ntz")).otherwise(t.try_cast("timestamp_ntz"))


def month_index(d: ColumnOrName) -> Column:
    d = _c(d)
    return F.year(d) * 12 + F.month(d)


def months_between_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of month boundaries crossed: 31 Jan -> 1 Feb is 1."""
    return month_index(end) - month_index(start)


def weeks_between_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of Monday week boundaries crossed."""
    return (F.datediff(F.trunc(_c(end), "week"), F.trunc(_c(start), "week")) / 7).cast("int")


def years_between_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.year(_c(end)) - F.year(_c(start))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(_c(end), _c(start))


def age_years(birth: ColumnOrName, as_of) -> Column:
    """``floor(days / 365.25)``; NULL birth date gives NULL."""
    return F.floor(F.datediff(as_date(as_of), _c(birth)) / F.lit(365.25)).cast("int")


def member_months(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Boundary month count + 1, floored at 0; either end NULL gives 0."""
    s, e = _c(start), _c(end)
    return (
        F.when(s.isNull() | e.isNull(), F.lit(0))
        .otherwise(F.greatest(months_between_boundaries(s, e) + 1, F.lit(0)))
    )


def day_of_week_sun0(d: ColumnOrName) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def quarter_end(d: ColumnOrName) -> Column:
    return F.date_add(F.add_months(F.trunc(_c(d), "quarter"), 3), -1)


def year_end(d: ColumnOrName) -> Column:
    return F.date_add(F.add_months(F.trunc(_c(d), "year"), 12), -1)


def year_month(d: ColumnOrName) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(_c(d), "MM")
