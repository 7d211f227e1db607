"""Claims marts kept current month by month.

Claims and lines are stored tables that loads are merged into; the fact, the
claims summary and the medical expense mart are tables of months.  A refresh
asks the stored tables which rows changed since the versions that a mart was built from, turns
them into service months (before and after the change), and replaces those months only.

A mart's commit record names the versions it was built from.  So a refresh that
failed half-way, or whose loads were committed without one, is made good by the next
call, and a call without new loads writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fx
from ..operators.upsert import IncrementalTable
from ..sources.io import PartTable
from . import core, marts, staging

#: The part of claims without a service date.
UNDATED = "undated"
#: Stored claims per task that a month's facts are dealt to.
PIECE_CLAIMS = 5_000_000


def month_part(date: Column | str) -> Column:
    return F.coalesce(F.date_format(fx.month_start(F.col(date) if isinstance(date, str) else date), "yyyy-MM"), F.lit(UNDATED))


class ClaimMarts:
    """The stored claims and lines under ``root``, and the marts over them."""

    def __init__(self, spark: SparkSession, root: str, members: DataFrame, providers: DataFrame, member_months: DataFrame, buckets: int = 16):
        self.claims = IncrementalTable(spark, "stg_clclaim", "claim_id", root=root, buckets=buckets)
        self.lines = IncrementalTable(spark, "stg_clline", "claim_line_id", root=root, buckets=buckets)
        self.fact, self.summary, self.expense = (PartTable(spark, f"{root}/{n}") for n in ("fct_claim", "mart_claims_summary", "mart_medical_expense"))
        self.members = members
        self.providers = providers
        self.member_months = member_months
        self._changed: dict[str, list[str]] = {}

    def load(self, claims: DataFrame, lines: DataFrame) -> None:
        """Merges raw extracts of claims and lines."""
        self.claims.upsert(claims, stage=staging.stg_clclaim)
        self.lines.upsert(lines, stage=staging.stg_clline)

    def _versions(self) -> dict[str, int]:
        return {"claims": self.claims.version(), "lines": self.lines.version()}

    def changed_months(self, since: dict[str, int]) -> list[str]:
        """The months of claims that changed, or whose lines did, after the versions ``since``: as they were and as they are."""
        now, touched = self._versions(), []
        asked = f"{sorted(since.items())} {sorted(now.items())}"
        if asked in self._changed:  # versions never change, and the marts are mostly built from the same ones
            return self._changed[asked]
        for v in range(since["claims"] + 1, now["claims"] + 1):
            touched += [df.select(month_part("service_from_date").alias("m")) for df in self.claims.changes(v)]
        ids = [df.select("claim_id") for v in range(since["lines"] + 1, now["lines"] + 1) for df in self.lines.changes(v)]
        if ids:
            of_lines = ids[0]
            for more in ids[1:]:
                of_lines = of_lines.unionByName(more)
            touched.append(self.claims.read().join(of_lines, "claim_id", "left_semi").select(month_part("service_from_date").alias("m")))
        months: set[str] = set()
        for df in touched:
            months |= {r.m for r in df.distinct().collect()}  # no more than there are months
        self._changed = {asked: sorted(months)}
        return self._changed[asked]

    def _refresh(self, table: PartTable, make: Callable[[list[str] | None], DataFrame], part: Column) -> None:
        before, now = table.current(), self._versions()
        if before and before["built"] == now:
            return
        months = None if before is None else self.changed_months(before["built"])
        if months == []:
            table.note(built=now)
            return
        rows = make(months)
        # A month of facts is as many tasks' work as its share of the stored claims asks for.
        piece = [F.pmod(F.xxhash64("claim_id"), F.lit(1 + self.claims.count() // PIECE_CLAIMS))] if "claim_id" in rows.columns else []
        hashes = [f.name for f in rows.schema.fields if f.name.endswith("_key") and isinstance(f.dataType, T.StringType)]
        rows = rows.withColumns({k: fx.packed(k) for k in hashes}).repartition(part, *piece).withColumns({k: fx.unpacked(k) for k in hashes})
        table.replace(rows, part, months or (), {"built": now})

    def refresh(self) -> None:
        def dated(df: DataFrame, months: list[str] | None, column: str) -> DataFrame:
            return df if months is None else df.where(month_part(column).isin(months))

        def fact(months: list[str] | None) -> DataFrame:
            claims = dated(self.claims.read(), months, "service_from_date")
            lines = self.lines.read()
            if months is not None:
                lines = lines.join(claims.select("claim_id"), "claim_id", "left_semi")
            tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            return core.fct_claim(claims, lines, self.members, self.providers, **core.lookup_plan(core.legacy_links(self.members, self.providers), tasks))

        self._refresh(self.fact, fact, month_part("service_from_date"))
        self._refresh(self.summary, lambda months: marts.mart_claims_summary(self.fact.read(months), self.members), month_part("service_month"))
        self._refresh(self.expense, lambda months: marts.mart_medical_expense(
            self.summary.read(months), dated(self.member_months, months, "calendar_month")), month_part("report_month"))
