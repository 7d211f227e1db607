"""Benchmark the headline queries; prints ONE JSON line.

Each query is executed to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  ``cold`` is the first run in a
fresh session (it includes landing the raw extracts); ``warm`` is the best of
two further passes over all queries (JIT and OS caches warm, less noise).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carespark.session import local_session  # noqa: E402

HEADLINE = [
    "mart_claims_summary",
    "mart_member_months",
    "mart_medical_expense",
    "fct_claim_conformed",
    "incremental_upsert",
    "snapshot_member",
    "dq_report",
]


def run(spark, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="carespark-bench")
    from carespark.plans.registry import QUERIES

    cold, warm = {}, {}
    for n in names:
        cold[n] = round(run(spark, QUERIES[n], sf_dir), 3)
    for _ in range(2):
        for n in names:
            t = round(run(spark, QUERIES[n], sf_dir), 3)
            warm[n] = min(t, warm.get(n, t))
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({
        "metric": "headline_total_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
