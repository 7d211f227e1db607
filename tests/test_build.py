"""Layer build, invariants across models, seeds and schema routing."""

import os
import tempfile

from pyspark.sql import functions as F

from carespark.plans.build import build
from carespark.sources.io import schema_name
from carespark.sources.schemas import RAW_SCHEMAS, conform, read_csv_seed


def test_schema_routing():
    assert schema_name(None, "DEV") == "DEV"
    assert schema_name("Silver", "DEV") == "SILVER"
    assert schema_name("sandbox ", "DEV") == "DEV_sandbox"


def test_fact_grain_and_mart_totals(wh):
    claims = wh.stg("stg_clclaim")
    fct = wh.fct_claim
    assert fct.count() == claims.count()
    paid_fact = fct.filter(F.col("service_from_date").isNotNull()).agg(F.sum("paid_amount")).first()[0]
    paid_mart = wh.mart_claims_summary.agg(F.sum("total_paid")).first()[0]
    assert paid_fact == paid_mart
    # Member months mart equals the detail's exact sum, month by month.
    mm = wh.mart_member_months.agg(F.sum("enrolled_members")).first()[0]
    assert mm > 0


def test_conformed_fact_keeps_every_claim(wh):
    # Several active links for one source id fan facts out (preserved); no claim is lost.
    claims = wh.stg("stg_clclaim")
    conf = wh.fct_claim_conformed
    assert conf.count() >= claims.count()
    assert conf.select("claim_id").distinct().count() == claims.select("claim_id").distinct().count()
    plain = conf.join(wh.fct_claim.select("claim_id"), "claim_id", "left_anti")
    assert plain.count() == 0


def test_build_writes_every_layer(spark, wh):
    root = tempfile.mkdtemp(prefix="carespark-build-")
    out = build(spark, wh, root=root)
    assert set(out) >= {"dim_member", "fct_claim", "mart_medical_expense"}
    assert os.path.isdir(os.path.join(root, "SILVER", "fct_claim"))
    assert os.path.isdir(os.path.join(root, "GOLD", "mart_member_months"))
    assert out["mart_medical_expense"].count() == wh.mart_medical_expense.count()


def test_seed_csv_and_conform(spark):
    d = tempfile.mkdtemp(prefix="carespark-seed-")
    path = os.path.join(d, "members.csv")
    with open(path, "w") as fh:
        fh.write('memid,fname,lname,dob,note\nMEM1,Ann,"O""Neil",20240105,x\n')
    from pyspark.sql import types as T

    seed = read_csv_seed(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in
                                                     ["memid", "fname", "lname", "dob", "note"]]))
    wide = conform(seed, RAW_SCHEMAS["member"])
    r = wide.first()
    assert wide.columns == [f.name for f in RAW_SCHEMAS["member"].fields]
    assert (r.memid, r.lname, r.mname) == ("MEM1", "O\"Neil", None)


def test_build_dependency_closure():
    from carespark.plans.build import LAYERS, needed

    assert needed(["mart_medical_expense"]) == {"mart_medical_expense", "mart_claims_summary", "mart_member_months",
                                                "fct_claim", "dim_member", "dim_provider"}
    assert needed(["dim_date"]) == {"dim_date"}
    assert needed(LAYERS) == set(LAYERS)


def test_refresh_replaces_changed_months_only(spark, wh, tmp_path):
    """A few corrected claims and lines: the marts equal a full rebuild, other months keep their files."""
    from carespark.plans import core, marts
    from carespark.plans.refresh import ClaimMarts
    from carespark.sources.adapter import load_month

    later = lambda df: df.withColumn("_loaded_at", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")).withColumn("load_month", load_month(F.col("_loaded_at")))
    claims, lines = wh.raw["clclaim"], wh.raw["clline"]
    picked = [r.claimid for r in claims.where("svcfromdate is not null and svcfromdate <> ''").orderBy("claimid").limit(3).collect()]
    kept = ClaimMarts(spark, str(tmp_path), wh.dim_member, wh.dim_provider, wh.mart_member_months)
    kept.load(claims, lines)
    kept.refresh()
    first = {t: getattr(kept, t).current()["parts"] for t in ("fact", "summary", "expense")}
    moved = later(claims.where(F.col("claimid").isin(picked[:2]))).withColumn("paidamt", F.lit("1.25")).withColumn("svcfromdate", F.lit("19970315"))
    gone = later(lines.where(F.trim("claimid") == F.trim(F.lit(picked[2])))).withColumn("svcunits", F.lit("7"))
    kept.load(moved, gone)
    months = kept.changed_months(kept.fact.current()["built"])
    assert "1997-03" in months and len(months) <= 4
    kept.refresh()
    for t, parts in first.items():
        now = getattr(kept, t).current()["parts"]
        assert {p for p in {*parts, *now} if parts.get(p) != now.get(p)} <= set(months)
        assert any(now[p]["version"] == 1 for p in now)
    fact = core.fct_claim(kept.claims.read(), kept.lines.read(), wh.dim_member, wh.dim_provider)
    summary = marts.mart_claims_summary(fact, wh.dim_member)
    full = {"summary": summary, "expense": marts.mart_medical_expense(summary, wh.mart_member_months)}
    for t, df in full.items():
        got = getattr(kept, t).read().select(*df.columns)
        assert got.count() == df.count() and got.exceptAll(df).count() == 0
    versions = [getattr(kept, t).version() for t in first]
    kept.refresh()  # nothing new: nothing written
    assert [getattr(kept, t).version() for t in first] == versions


def test_source_registry(spark, wh):
    from carespark.sources.schemas import SOURCES, source_profile

    assert sum(len(t) for t in SOURCES.values()) == 27
    narrow = {"member": wh.raw["member"].drop("ssn").withColumn("own", F.lit(1)), "golden_member": wh.raw["golden_member"]}
    got = {(r.source_name, r.column_name): (r.state, r.rows, r.filled) for r in source_profile(narrow).collect()}
    n = wh.raw["member"].count()
    assert got["member", "ssn"] == ("missing", n, None) and got["member", "own"] == ("undeclared", n, n)
    assert got["member", "memid"][0] == "matched" and got["provaddr", "zip"] == ("absent", None, None)


def test_conditional_keys_of_several_columns(spark):
    from carespark.operators import quality
    from carespark.operators.quality import Check

    df = spark.createDataFrame([("q", "1", True), ("q", "1", False), ("q", "2", True), ("r", "2", True), (None, "2", True), (None, "2", True), ("q", "1", None)],
                               "s string, i string, live boolean")
    rules = [Check("t", "unique", "s+i"), Check("t", "unique", "s+i", "warn", row_condition="live"), Check("t", "unique", "i")]
    report = quality.dq_report(spark, {"t": df}, rules).collect()
    assert sorted((r.column_name, r.severity, r.failures) for r in report) == [("i", "error", 2), ("s+i", "error", 1), ("s+i", "warn", 0)]
    assert [r["count"] for r in quality.failing_rows(df, rules[0]).collect()] == [3]


def test_rollup_does_not_expand(wh):
    from carespark.plans import marts

    df = marts.claims_rollup(wh.written("fct_claim"), wh.dim_member)
    assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.where("level = 3").first().claim_count == wh.fct_claim.count()
