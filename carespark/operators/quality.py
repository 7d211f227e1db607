"""Data-quality checks: failing rows per rule, and one report over a suite.

Row-level rules of one table (not null, accepted values, between, column
pair order) are evaluated together in ONE aggregation pass per table;
uniqueness and referential rules need their own grouped / anti-join pass.
The report is a small DataFrame (one row per rule); nothing is collected.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import packed

ROW_LEVEL = {"not_null", "accepted_values", "between", "pair_ge", "type"}


@dataclass(frozen=True)
class Check:
    model: str
    kind: str  # not_null | unique | accepted_values | relationships | between | pair_ge | type
    column: str  # of a unique rule also several, joined by "+"
    severity: str = "error"
    values: tuple = ()
    to_model: str | None = None
    to_field: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    column_b: str | None = None
    or_equal: bool = True
    row_condition: str | None = None
    type_name: str | None = None
    extra: Mapping = field(default_factory=dict)

    @property
    def rule(self) -> str:
        return self.kind

    @property
    def columns(self) -> list[str]:
        return self.column.split("+")


def _cond(check: Check) -> Column:
    return F.expr(check.row_condition) if check.row_condition else F.lit(True)


def fail_predicate(check: Check) -> Column:
    """Row-level predicate that is TRUE exactly for failing rows (NULL = pass)."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(*check.values)
    if check.kind == "between":
        ok = F.lit(True)
        if check.min_value is not None:
            ok = ok & (c >= F.lit(check.min_value))
        if check.max_value is not None:
            ok = ok & (c <= F.lit(check.max_value))
        return _cond(check) & ~ok
    if check.kind == "type":
        return F.typeof(c) != check.type_name
    if check.kind == "pair_ge":
        b = F.col(check.column_b)
        ok = (c >= b) if check.or_equal else (c > b)
        return _cond(check) & ~ok
    raise ValueError(f"{check.kind} is not a row-level rule")


def _counted(check: Check) -> Column:
    """The rows that a unique rule looks at: those that meet its condition and have no NULL among its columns."""
    known = F.lit(True)
    for c in check.columns:
        known = known & F.col(c).isNotNull()
    return F.coalesce(_cond(check), F.lit(False)) & known


def read_columns(df: DataFrame, model: str, checks: list[Check]) -> list[str]:
    """The columns of df, which is ``model``, that the checks read."""
    read = set()
    for ch in checks:
        if ch.model == model:
            read |= {*ch.columns, ch.column_b, *re.findall(r"\w+", ch.row_condition or "")}
        if ch.to_model == model:
            read.add(ch.to_field)
    return [c for c in df.columns if c in read]


def failing_rows(df: DataFrame, check: Check, models: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows (or duplicated values) that violate ``check``."""
    if check.kind in ROW_LEVEL:
        return df.filter(F.coalesce(fail_predicate(check), F.lit(False)))
    if check.kind == "unique":
        return df.filter(_counted(check)).groupBy(*check.columns).count().filter(F.col("count") > 1)
    c = F.col(check.column)
    if check.kind == "relationships":
        parent = models[check.to_model].select(F.col(check.to_field).alias("_parent_key"))
        return df.filter(c.isNotNull()).join(parent, c == F.col("_parent_key"), "left_anti")
    raise ValueError(f"no failing-row form for {check.kind}")


def _meta(check: Check) -> list[Column]:
    return [F.lit(check.model).alias("table_name"), F.lit(check.rule).alias("rule"),
            F.lit(check.column).alias("column_name"), F.lit(check.severity).alias("severity")]


def _unique_counts(df: DataFrame, group: list[Check]) -> DataFrame:
    """Duplicated values (or combinations) per unique rule of one table, in one scan and one shuffle.

    Every row gives one narrow (rule, values) row per rule whose condition it meets; hashes take half their letters in it.
    """
    told = [F.when(_counted(ch), F.struct(F.lit(i).alias("i"), F.array(*[packed(F.col(c).cast("string")) for c in ch.columns]).alias("v")))
            for i, ch in enumerate(group)]
    values = df.select(F.explode(F.array_compact(F.array(*told))).alias("x")).select("x.i", "x.v")
    twice = values.groupBy("i", "v").count().filter(F.col("count") > 1)
    one = twice.agg(*[F.count(F.when(F.col("i") == i, 1)).alias(f"f{i}") for i in range(len(group))])
    return one.select(F.inline(F.array(*[F.struct(*_meta(ch), F.col(f"f{i}").cast("bigint").alias("failures")) for i, ch in enumerate(group)])))


def dq_report(spark: SparkSession, models: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in ROW_LEVEL:
            by_model.setdefault(ch.model, []).append(ch)
    for model, group in by_model.items():
        sums = [F.sum(F.when(fail_predicate(ch), 1).otherwise(0)).alias(f"f{i}") for i, ch in enumerate(group)]
        one = models[model].agg(*sums)
        rows = F.array(*[F.struct(*_meta(ch), F.coalesce(F.col(f"f{i}"), F.lit(0)).cast("bigint").alias("failures"))
                         for i, ch in enumerate(group)])
        parts.append(one.select(F.inline(rows)))
    for model in dict.fromkeys(ch.model for ch in checks if ch.kind == "unique"):
        parts.append(_unique_counts(models[model], [ch for ch in checks if ch.model == model and ch.kind == "unique"]))
    for ch in checks:
        if ch.kind == "relationships":
            n = failing_rows(models[ch.model], ch, models).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(n.select(*_meta(ch), F.col("failures").cast("bigint")))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    status = (F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return report.withColumn("status", status)


def freshness(sources: Mapping[str, DataFrame], groups: Mapping[str, str], as_of_ts, warn_hours: int = 24, error_hours: int = 48,
              loaded_at: str = "_loaded_at") -> DataFrame:
    """Per source (and its group): newest load time, its age at ``as_of_ts`` and pass/warn/error."""
    from ..functions import round_ratio
    from ..functions.dates import ntz_lit

    now = ntz_lit(as_of_ts)
    parts = []
    for name, df in sources.items():
        parts.append(df.agg(F.max(loaded_at).alias("max_loaded_at")).select(
            F.lit(groups[name]).alias("source_group"), F.lit(name).alias("source_name"), "max_loaded_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    micros = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now)
    hour = 3600 * 1_000_000
    return out.select(
        "source_group", "source_name", "max_loaded_at",
        round_ratio(micros, F.lit(hour), 2).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(micros > error_hours * hour, "error")
        .when(micros > warn_hours * hour, "warn").otherwise("pass").alias("status"),
    )
