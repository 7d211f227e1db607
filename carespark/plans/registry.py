"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` (through the raw-extract
adapter), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import session_id
from ..sources.adapter import input_files
from .warehouse import MODEL_NAMES, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(name: str, fn: Query) -> None:
    QUERIES[name] = fn


_WAREHOUSES: dict[tuple, Warehouse] = {}


def shared_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One lazy model graph per session, data directory and input fingerprint.

    Only *plans* are shared (already analysed DataFrames); every action still
    reads and computes from the files.  A changed input file changes the
    fingerprint and therefore gets a fresh graph.
    """
    sf = sf_dir.rstrip("/")
    stamp = [(t, str(input_files(spark, f"{sf}/{t}.parquet"))) for t in ("customer", "supplier", "part", "orders", "lineitem", "events")]
    key = (id(spark), session_id(spark), sf, tuple(stamp))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse.from_driver(spark, sf)
    return _WAREHOUSES[key]


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shared_warehouse(spark, sf_dir).model(name)

    run.__name__ = name
    return run


for _name in MODEL_NAMES:
    register(_name, _model_query(_name))


# ---------------------------------------------------------------- scenarios
from functools import reduce  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from .. import functions as fx  # noqa: E402
from ..operators import quality  # noqa: E402
from ..sources.schemas import RAW_SCHEMAS, conform, source_profile  # noqa: E402
from . import checks, marts, scenarios  # noqa: E402


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return shared_warehouse(spark, sf_dir)


def _fresh_root(spark: SparkSession, label: str) -> str:
    """A folder of its own for a scenario's stored tables, in the shared work root."""
    import uuid

    from ..session import work_root

    return f"{work_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


for _inc in ("incremental_watermark", "incremental_upsert", "schema_append"):
    register(_inc, lambda s, d, n=_inc: getattr(scenarios, n)(s, _wh(s, d).raw["cladjust"], _fresh_root(s, n)))
for _inc in scenarios.INCREMENTAL:
    register(f"incremental_{_inc}",
             lambda s, d, n=_inc: scenarios.incremental_load(s, _wh(s, d).raw[n], n, _fresh_root(s, f"incremental-{n}")))


def _refreshed(table: str) -> Query:
    """Two loads of claims and lines, a refresh of the marts after each."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .refresh import ClaimMarts

        wh = _wh(spark, sf_dir)
        kept = ClaimMarts(spark, _fresh_root(spark, "refresh"), wh.dim_member, wh.dim_provider, wh.written("mart_member_months"))
        loads = [scenarios.load_batches(wh.raw[n], *scenarios.INCREMENTAL[n][2:]) for n in ("clclaim", "clline")]
        for claims, lines in zip(*loads):
            kept.load(claims, lines)
            kept.refresh()
        return getattr(kept, table).read()

    return run


register("refresh_claims_summary", _refreshed("summary"))
register("refresh_medical_expense", _refreshed("expense"))
register("claims_rollup", lambda s, d: marts.claims_rollup(_wh(s, d).written("fct_claim"), _wh(s, d).dim_member))
for _snap, _spec in scenarios.SNAPSHOTS.items():
    register(f"snapshot_{_snap}",
             lambda s, d, n=_snap, st=_spec[0]: scenarios.stored_snapshot(s, _wh(s, d).stg(st), n, _fresh_root(s, "snapshots")))
register("snapshot_asof", lambda s, d: scenarios.snapshot_asof(_wh(s, d).stg("stg_member")))


# ------------------------------------------------------------------ quality
def _suite_models(wh: Warehouse, names) -> dict:
    return {n: wh.model(n) for n in names}


def _dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole suite against written tables, as tests after a build are.

    Staging models are views, so of them a table of the columns that the suite reads is written, once for all checks; raw
    tables are tested as they landed, every silver and gold model as
    the table that was built (``Warehouse.written``: written on first use, from the
    written models below).  So the checks scan tables and derive no model again.
    """
    wh = _wh(spark, sf_dir)
    names = checks.SUITE_MODELS
    columns = {n: quality.read_columns(wh.model(n), n, checks.SUITE) for n in names if n.startswith("stg_")}
    wh.write_all([n for n in names if not n.startswith("raw_")], columns=columns)
    models = {n: wh.raw[n[len("raw_"):]] if n.startswith("raw_") else wh.written(n, columns.get(n)) for n in names}
    return quality.dq_report(spark, models, checks.SUITE)


register("dq_report", _dq_report)


def _dq_example(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ch = checks.EXAMPLES[name]
        wh = _wh(spark, sf_dir)
        models = _suite_models(wh, {ch.model} | ({ch.to_model} if ch.to_model else set()))
        return quality.failing_rows(models[ch.model], ch, models)

    return run


for _dq in ("dq_not_null", "dq_unique", "dq_accepted_values", "dq_relationships", "dq_between", "dq_pair_order"):
    register(_dq, _dq_example(_dq))


def _dq_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    return quality.dq_report(spark, {"stg_member": wh.stg("stg_member")}, [checks.TYPE_CHECK])


register("dq_type", _dq_type)


def _freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    return quality.freshness({s: wh.raw[s] for s in checks.SOURCE_GROUPS}, checks.SOURCE_GROUPS, checks.FRESHNESS_AS_OF)


register("freshness", _freshness)


def _source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    return source_profile({name: wh.raw[name] for name in wh.raw.names})


register("source_profile", _source_profile)


# ------------------------------------------------------------------ lookups
def _identity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    x = wh.stg("stg_member_crosswalk").filter(F.col("is_active") == True).alias("x")  # noqa: E712
    g = wh.dim_golden_member.select("golden_member_id", "full_name").alias("g")
    return x.join(g, F.col("x.golden_member_id") == F.col("g.golden_member_id"), "inner").select(
        F.col("x.golden_member_id"), "g.full_name", "x.source_system", "x.source_member_id", "x.is_primary",
        "x.match_confidence")


def _resolved_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    c = wh.fct_claim_conformed.alias("c")
    g = wh.dim_golden_member.select("golden_member_id", "full_name", "source_systems").alias("g")
    return c.join(g, F.col("c.member_golden_id") == F.col("g.golden_member_id"), "inner").select(
        "c.claim_id", "c.member_golden_id", "g.full_name", "g.source_systems", "c.service_from_date",
        "c.paid_amount")


STATUS_SCHEMA = T.StructType([
    T.StructField("status_code", T.StringType()), T.StructField("status_name", T.StringType()),
    T.StructField("status_category", T.StringType()), T.StructField("is_final", T.BooleanType()),
    T.StructField("is_payable", T.BooleanType()),
])


def _status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = spark.createDataFrame(fx.CLAIM_STATUS_REFERENCE, STATUS_SCHEMA)
    c = _wh(spark, sf_dir).stg("stg_clclaim")
    # Ten fixed rows: a broadcast of proven size.
    return c.join(F.broadcast(ref), c.claim_status_code == ref.status_code, "left").select(
        "claim_id", "claim_status_code", "status_name", "status_category", "is_final", "is_payable")


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    parts = [wh.raw[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
             for t in checks.ROW_COUNT_TABLES]
    return reduce(DataFrame.unionByName, parts)


def _conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = _wh(spark, sf_dir).raw["member"].select("memid", "fname", "lname", "dob", "sex", "status", "email",
                                                     "language", "_loaded_at")
    return conform(narrow, RAW_SCHEMAS["member"])


register("identity_lookup", _identity_lookup)
register("resolved_claims", _resolved_claims)
register("status_lookup", _status_lookup)
register("row_counts", _row_counts)
register("conform_schema", _conform_schema)


# ---------------------------------------------------------- column helpers
from . import function_queries  # noqa: E402

for _fn in function_queries.FUNCTION_QUERIES:
    register(_fn, lambda s, d, n=_fn: function_queries.run(_wh(s, d), n))


# ---------------------------------------------------------------- streaming
def _stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads arrive as files; each is drained one file an epoch into a stored table."""
    from ..operators.upsert import IncrementalTable
    from ..streaming.upsert_stream import drain
    from . import staging

    run = _fresh_root(spark, "stream-upsert")
    table = IncrementalTable(spark, "stg_cladjust", scenarios.ADJUST_KEY, root=run)
    for i, batch in enumerate(scenarios.adjustment_batches(_wh(spark, sf_dir).raw["cladjust"]), start=1):
        batch.repartition(2).write.parquet(f"{run}/incoming/load-{i}")
        out = drain(spark, f"{run}/incoming/load-*", batch.schema, staging.stg_cladjust, table, f"{run}/checkpoint", files_per_batch=1)
    return out


register("stream_upsert", _stream_upsert)
register("snapshot_changes", lambda s, d: scenarios.snapshot_changes(_wh(s, d).stg("stg_member")))


def _setup_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.schemas import default_eligibility

    return default_eligibility(_wh(spark, sf_dir).raw["member"], "2001-06-01 00:00:00")


register("setup_eligibility", _setup_eligibility)
