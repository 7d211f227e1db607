"""Model graph: every staged table, dimension, fact and mart by name.

``Warehouse`` wires the pure model functions together over one set of raw
extracts.  Models are lazy plans, except where a model is a table that others
read: over landed extracts (``RawSource``) the claim header and lines are stored
once in buckets of ``claim_id`` (``by_claim``), and the marts read the written fact
and marts below them (``written``), so a fact is computed once for all that read it.
Stored copies are keyed by the extracts' fingerprint, the reporting date and the text of
the model code, so another input or rule makes another copy.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import inspect
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import functions
from ..operators import skew
from ..session import default_parallelism, freed_shuffles, work_root
from ..sources.adapter import AS_OF, SOURCE_SYSTEM, RawSource
from ..sources.io import CODEC, VersionedTable
from . import core, marts, staging


class Warehouse:
    def __init__(self, raw: dict[str, DataFrame] | RawSource, spark: SparkSession | None = None,
                 as_of: dt.date = AS_OF, source_system: str = SOURCE_SYSTEM):
        self.raw = raw
        self.as_of = as_of
        self.source_system = source_system
        self.spark = spark or getattr(raw, "spark", None)
        self._staged: dict[str, DataFrame] = {}
        self._written: dict[str, DataFrame] = {}

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
        return cls(RawSource(spark, sf_dir), spark, **kw)

    # ------------------------------------------------------------ staging
    def stg(self, name: str) -> DataFrame:
        if name not in self._staged:
            table, _ = staging.STAGING[name]
            self._staged[name] = staging.stage(name, self.raw[table], self.as_of)
        return self._staged[name]

    # ------------------------------------------------------------- stored
    @cached_property
    def _stamp(self) -> str | None:
        """What a stored copy depends on; None over extracts that aren't landed (everything stays lazy then)."""
        if not isinstance(self.raw, RawSource) or not self.raw.land:
            return None
        rules = "".join(inspect.getsource(m) for m in (core, marts, staging, functions.cleaning, functions.dates, functions.numeric))
        told = [rules, str(self.as_of), self.source_system, *(self.raw.landing_path(t) for t in sorted(self.raw.names))]
        return hashlib.md5("|".join(told).encode()).hexdigest()[:16]

    def _store(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{work_root(self.spark).rstrip('/')}/models/{self._stamp}/{name}")

    def written(self, name: str, columns: list[str] | None = None) -> DataFrame:
        """The model, or some of its columns, as a table, written on first use."""
        model = self.model(name) if columns is None else self.model(name).select(*columns)
        if self._stamp is None:
            return model
        key = name if columns is None else f"{name}-{hashlib.md5('|'.join(columns).encode()).hexdigest()[:8]}"
        if key not in self._written:
            table = self._store(key)
            self._written[key] = table.read() or table.write(model)
        return self._written[key]

    def write_all(self, names, threads: int = 4, columns: dict[str, list[str]] | None = None) -> None:
        """Writes what isn't written yet, models that others read first; independent ones as concurrent jobs.

        Of models in ``columns``, those columns.
        """
        from .build import DEPENDS, run_level

        columns = columns or {}
        todo = {n for n in names if n not in self._written}
        read = {"fct_claim", "mart_claims_summary", "mart_member_months"}  # what the marts read as tables
        todo |= {d for n in todo for d in DEPENDS.get(n, ()) if d in read and d not in self._written}
        while todo:
            ready = {n for n in todo if not (DEPENDS.get(n, set()) & todo & read)}
            for n in ready:
                self.model(n)  # plans are built one after the other, and shared
            run_level({n: (lambda n=n: self.written(n, columns.get(n))) for n in sorted(ready)}, threads)
            todo -= ready

    def by_claim(self, name: str) -> DataFrame:
        """A staged table stored in buckets of claim_id: joins and roll-ups on it need no exchange.

        Of the lines, what their roll-up reads.
        """
        if self._stamp is None:
            return self.stg(name)
        key = f"{name}_by_claim"
        if key not in self._written:
            store = self._store(key)
            n = self.claim_buckets
            table = f"carespark_{self._stamp}_{key}"
            staged = self.stg(name).select(*core.ROLLED) if name == "stg_clline" else self.stg(name)
            if store.version() == 0:
                self.spark.sql(f"drop table if exists {table}")
                with freed_shuffles(self.spark):
                    (staged.repartition(n, "claim_id").write.mode("overwrite").bucketBy(n, "claim_id").sortBy("claim_id")
                     .option("compression", CODEC).option("path", store.version_path(1)).saveAsTable(table))
                store.commit_written()
            elif not self.spark.catalog.tableExists(table):  # stored by another session
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.schema.fields)
                self.spark.sql(f"create table {table} ({columns}) using parquet clustered by (claim_id) sorted by (claim_id) "
                               f"into {n} buckets location '{store.version_path(1)}'")
            self._written[key] = self.spark.table(table)
        return self._written[key]

    @cached_property
    def claim_buckets(self) -> int:
        """Header and lines have the same number of buckets, after the larger of them."""
        return max(default_parallelism(self.spark), self.raw.partitions("clline"), self.raw.partitions("clclaim"))

    @cached_property
    def busy_ids(self) -> list[tuple]:
        """The heavy ids among all roles of the claims (at most a thousand)."""
        return skew.heavy_keys(core.role_ids(self.by_claim("stg_clclaim")), ["kind", "id"])

    @cached_property
    def segments(self) -> DataFrame:
        """Staged segments for their expansion to months: as many tasks as their rows ask for, however few files a scan packs them into."""
        staged = self.stg("stg_mbrelig")
        return staged if self.segment_tasks is None else staged.repartition(self.segment_tasks)

    @cached_property
    def segment_tasks(self) -> int | None:
        return None if self._stamp is None else self.raw.partitions("mbrelig")

    # ------------------------------------------------------------- silver
    @cached_property
    def dim_date(self) -> DataFrame:
        return core.dim_date_from_bounds(core.claim_calendar_bounds(self.stg("stg_clclaim")), self.as_of)

    @cached_property
    def dim_member(self) -> DataFrame:
        return core.dim_member(self.stg("stg_member"), self.stg("stg_mbrelig"), self.as_of)

    @cached_property
    def dim_provider(self) -> DataFrame:
        return core.dim_provider(self.stg("stg_provider"), self.as_of)

    @cached_property
    def dim_diagnosis(self) -> DataFrame:
        return core.dim_diagnosis(self.stg("stg_diagcode"), self.as_of)

    @cached_property
    def dim_golden_member(self) -> DataFrame:
        return core.dim_golden_member(self.stg("stg_golden_member"), self.stg("stg_member_crosswalk"),
                                      self.stg("stg_member"), self.as_of, self.source_system)

    @cached_property
    def dim_golden_provider(self) -> DataFrame:
        return core.dim_golden_provider(self.stg("stg_golden_provider"), self.stg("stg_provider_crosswalk"),
                                        self.stg("stg_provider"), self.source_system)

    @cached_property
    def fct_claim(self) -> DataFrame:
        return core.fct_claim(self.by_claim("stg_clclaim"), self.by_claim("stg_clline"), self.dim_member, self.dim_provider, self.busy_ids,
                              **self._lookup(core.legacy_links(self.dim_member, self.dim_provider)))

    @cached_property
    def fct_claim_conformed(self) -> DataFrame:
        identities = (self.stg("stg_member_crosswalk"), self.stg("stg_provider_crosswalk"), self.dim_golden_member, self.dim_golden_provider,
                      self.dim_member, self.dim_provider, self.source_system)
        return core.fct_claim_conformed(self.by_claim("stg_clclaim"), self.by_claim("stg_clline"), *identities, self.busy_ids,
                                        **self._lookup(core.conformed_links(*identities)))

    def _lookup(self, links: DataFrame) -> dict:
        """How the facts look ids up, over extracts that have landed."""
        return {} if self._stamp is None else core.lookup_plan(links, self.claim_buckets)

    # --------------------------------------------------------------- gold
    @cached_property
    def mart_claims_summary(self) -> DataFrame:
        return marts.mart_claims_summary(self.written("fct_claim"), self.dim_member)

    @cached_property
    def mart_member_months(self) -> DataFrame:
        return marts.mart_member_months(self.stg("stg_mbrelig"), self.as_of, self.segment_tasks)

    @cached_property
    def mart_medical_expense(self) -> DataFrame:
        return marts.mart_medical_expense(self.written("mart_claims_summary"), self.written("mart_member_months"))

    # ------------------------------------------------------ intermediates
    @cached_property
    def line_rollup(self) -> DataFrame:
        return core.line_rollup(self.stg("stg_clline"))

    @cached_property
    def latest_eligibility(self) -> DataFrame:
        return core.latest_eligibility(self.stg("stg_mbrelig"))

    @cached_property
    def eligibility_summary(self) -> DataFrame:
        return core.eligibility_summary(self.stg("stg_mbrelig"), self.as_of)

    @cached_property
    def member_month_detail(self) -> DataFrame:
        return marts.member_month_detail(self.segments, self.as_of)

    def model(self, name: str) -> DataFrame:
        if name in staging.STAGING:
            return self.stg(name)
        return getattr(self, name)


MODEL_NAMES = [
    *staging.STAGING,
    "dim_date", "dim_member", "dim_provider", "dim_diagnosis", "dim_golden_member", "dim_golden_provider",
    "fct_claim", "fct_claim_conformed", "line_rollup", "latest_eligibility", "eligibility_summary",
    "member_month_detail", "mart_claims_summary", "mart_member_months", "mart_medical_expense",
]
