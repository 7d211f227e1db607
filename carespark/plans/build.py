"""Materialise the warehouse: silver and gold models written as tables.

Staging stays lazy (views).  Each silver/gold model is written once, in
dependency order, to ``<root>/<SCHEMA>/<table>`` and every later model reads
the *written* table, so lineage is cut at each layer and a lost executor only
re-runs the tasks of the table being written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..session import work_root
from ..sources.adapter import AS_OF
from ..sources.io import VersionedTable, layer_path, schema_name, with_audit
from . import core, marts
from .warehouse import Warehouse

# model -> custom schema (layer)
LAYERS = {
    "dim_date": "silver", "dim_member": "silver", "dim_provider": "silver", "dim_diagnosis": "silver",
    "dim_golden_member": "silver", "dim_golden_provider": "silver", "fct_claim": "silver",
    "fct_claim_conformed": "silver", "mart_claims_summary": "gold", "mart_member_months": "gold",
    "mart_medical_expense": "gold",
}


def run_level(jobs: dict, threads: int) -> dict[str, DataFrame]:
    """Run independent model writes of one dependency level as concurrent Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor

    if threads <= 1 or len(jobs) == 1:
        return {name: fn() for name, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(threads, len(jobs))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


# Written models each model reads (only silver/gold; staging is always available).
DEPENDS = {
    "fct_claim": {"dim_member", "dim_provider"},
    "fct_claim_conformed": {"dim_golden_member", "dim_golden_provider", "dim_member", "dim_provider"},
    "mart_claims_summary": {"fct_claim", "dim_member"},
    "mart_medical_expense": {"mart_claims_summary", "mart_member_months"},
}


def needed(targets) -> set[str]:
    todo, seen = list(targets), set()
    while todo:
        n = todo.pop()
        if n not in seen:
            seen.add(n)
            todo.extend(DEPENDS.get(n, ()))
    return seen


def build(spark: SparkSession, wh: Warehouse, root: str | None = None, default_schema: str = "ANALYTICS",
          as_of: dt.date = AS_OF, threads: int = 4, only=None) -> dict[str, DataFrame]:
    """Write silver then gold, level by level; models of one level run as concurrent jobs.

    ``only`` restricts the build to those models and what they read.
    """
    root = root or f"{work_root(spark).rstrip('/')}/warehouse"
    out: dict[str, DataFrame] = {}
    wanted = needed(only) if only is not None else set(LAYERS)

    def publish(name: str, make) -> DataFrame:
        table = VersionedTable(spark, layer_path(root, schema_name(LAYERS[name], default_schema), name))
        return table.write(with_audit(make())).drop("dbt_updated_at")

    def level(models: dict) -> None:
        jobs = {n: (lambda n=n, f=f: publish(n, f)) for n, f in models.items() if n in wanted}
        if jobs:
            out.update(run_level(jobs, threads))

    stg = wh.stg
    level({
        "dim_date": lambda: wh.dim_date,
        "dim_member": lambda: wh.dim_member,
        "dim_provider": lambda: wh.dim_provider,
        "dim_diagnosis": lambda: wh.dim_diagnosis,
        "mart_member_months": lambda: marts.mart_member_months(wh.stg("stg_mbrelig"), as_of, wh.segment_tasks),
    })
    level({
        "dim_golden_member": lambda: core.dim_golden_member(
            stg("stg_golden_member"), stg("stg_member_crosswalk"), stg("stg_member"), as_of, wh.source_system),
        "dim_golden_provider": lambda: core.dim_golden_provider(
            stg("stg_golden_provider"), stg("stg_provider_crosswalk"), stg("stg_provider"), wh.source_system),
        "fct_claim": lambda: core.fct_claim(wh.by_claim("stg_clclaim"), wh.by_claim("stg_clline"), out["dim_member"],
                                            out["dim_provider"], wh.busy_ids),
    })
    level({
        "fct_claim_conformed": lambda: core.fct_claim_conformed(
            wh.by_claim("stg_clclaim"), wh.by_claim("stg_clline"), stg("stg_member_crosswalk"), stg("stg_provider_crosswalk"),
            out["dim_golden_member"], out["dim_golden_provider"], out["dim_member"], out["dim_provider"],
            wh.source_system, wh.busy_ids),
        "mart_claims_summary": lambda: marts.mart_claims_summary(out["fct_claim"], out["dim_member"]),
    })
    level({"mart_medical_expense": lambda: marts.mart_medical_expense(out["mart_claims_summary"],
                                                                       out["mart_member_months"])})
    return out
