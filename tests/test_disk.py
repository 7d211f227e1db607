"""What stored tables and their loads leave on disk: rows written once, short keys in shuffles, freed shuffle files."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from carespark import functions as fx
from carespark.operators import upsert
from carespark.session import freed_shuffles
from carespark.sources.io import store

T0 = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)


def batch(spark, data):
    return spark.createDataFrame(data, "k string, v string, _loaded_at timestamp_ntz")


def test_a_load_writes_each_row_once(spark, tmp_path):
    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path), buckets=2)
    t.upsert(batch(spark, [(f"k{i}", "1", T0) for i in range(50)] + [(None, "n", T0)]))
    assert not glob.glob(f"{t.path}/arrived/v-000001/*/part-*")  # no copy beside the table
    t.upsert(batch(spark, [(f"k{i}", "2", T0 + DAY) for i in range(40, 60)] + [(None, "m", T0 + DAY)]))
    kept = spark.read.schema("k string, v string").parquet(f"{t.path}/data/v-000002")
    assert {r.v for r in kept.collect()} == {"1", "n"} and kept.count() == 41  # what arrived isn't written a second time
    got = sorted((r.k or "", r.v) for r in t.read().collect())
    assert got == sorted([(f"k{i}", "1" if i < 40 else "2") for i in range(60)] + [("", "n"), ("", "m")]) and t.count() == 62
    assert sum(p["rows"] for p in t.record(1)["parts"].values()) == t.read(record=t.record(1)).count() == 51
    new, old = t.changes()
    assert new.count() == 21 and {r.v for r in old.collect()} == {"1"} and old.count() == 10


def test_a_merge_shuffles_a_row_once(spark, tmp_path):
    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path), buckets=3)
    t.upsert(batch(spark, [("a", "1", T0), ("b", "1", T0)]))
    left = t._kept(t.read(), batch(spark, [("a", "2", T0 + DAY)]), 3)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and [r.k for r in left.collect()] == ["b"]


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "AB", "00ff", "d41d8cd98f00b204e9800998ecf8427e", "0x", "ab\n", "é", "clm 12", None])
def test_short_keys_come_back(spark, text):
    row = spark.createDataFrame([(text,)], "k string").select(fx.packed("k").alias("p")).select("p", fx.unpacked("p").alias("k")).first()
    assert row.k == text and (text is None or len(text) != 32 or len(row.p) == 17)


def test_written_tables_free_their_shuffles(spark, tmp_path):
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(conf, "false")
    with freed_shuffles(spark):
        with freed_shuffles(spark):
            pass
        assert spark.conf.get(conf) == "true"
    assert spark.conf.get(conf) == before
    store(spark.range(100).withColumn("p", F.col("id") % 2).repartition(3), f"{tmp_path}/t", ["p"])
    assert spark.conf.get(conf) == before and spark.read.parquet(f"{tmp_path}/t").count() == 100
    assert glob.glob(f"{tmp_path}/t/*/*.zstd.parquet")


def test_member_months_shuffle_segments_not_months(spark):
    from carespark.plans import marts

    d = dt.date
    seg = [("e1", "m1", d(2000, 1, 1), None, "P1", "18"), ("e2", "m1", d(2000, 1, 1), d(2000, 2, 10), "P1", "01"),
           (None, None, d(2000, 1, 1), d(2000, 1, 31), None, None), ("e2", "m2", None, d(2000, 1, 15), "P2", None)]
    elig = spark.createDataFrame([("COM", "PL", "Plan", None, "MED", *s) for s in seg],
                                 "line_of_business string, plan_id string, plan_name string, group_id string, coverage_type string, eligibility_id string,"
                                 "member_id string, effective_date date, termination_date date, pcp_provider_id string, relationship_code string")
    out = marts.mart_member_months(elig, d(2000, 3, 31))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "calendar_month" in x and "_id#" in x.split("coverage_type")[1]]
    got = {(r.calendar_month): (r.enrolled_members, r.active_eligibility_segments, r.assigned_pcps, float(r.member_months), r.full_month_members,
                                r.subscriber_count, r.dependent_count) for r in out.collect() if r.calendar_month.year == 2000}
    assert got == {d(2000, 1, 1): (2, 2, 2, 3.48, 1, 1, 1), d(2000, 2, 1): (1, 2, 1, 1.34, 1, 1, 1), d(2000, 3, 1): (1, 1, 1, 1.0, 1, 1, 0)}


def test_the_suite_writes_the_columns_of_staging_that_it_reads(spark, wh):
    from carespark.operators.quality import read_columns
    from carespark.plans import checks

    lines = read_columns(wh.stg("stg_clline"), "stg_clline", checks.SUITE)
    assert set(lines) == {"claim_line_id", "claim_id", "line_number", "service_from_date", "service_to_date", "billed_amount", "paid_amount"}
    assert "is_active" in read_columns(wh.stg("stg_member_crosswalk"), "stg_member_crosswalk", checks.SUITE)  # of a condition
    assert "provider_id" in read_columns(wh.stg("stg_provider"), "stg_provider", checks.SUITE)  # of a relationship


def test_links_are_short_on_their_way_to_the_claims(spark, wh):
    plan = wh.fct_claim_conformed._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan and {f.name for f in wh.fct_claim_conformed.schema} >= {"golden_member_key", "legacy_member_key"}
    found = wh.fct_claim_conformed.where("golden_member_key is not null").select("golden_member_key").first()[0]
    assert wh.dim_golden_member.where(F.col("golden_member_key") == found).count() > 0


def test_only_kinds_with_several_links_are_looked_up_again(spark, wh):
    from carespark.plans import core

    def links(*ids):
        rows = [("member", i, (f"k{n}",)) for n, i in enumerate(ids)] + [("provider", "P1", ("p",)), ("provider", None, ("q",)), ("provider", None, ("r",))]
        return spark.createDataFrame(rows, "kind string, id string, link struct<key: string>")

    assert core.fanned_kinds(links("M1", "M2")) == [] and core.fanned_kinds(links("M1", "M2", "M1")) == ["member"]
    claims = wh.stg("stg_clclaim").limit(1).withColumn("member_id", F.lit("M1")).withColumn("billing_provider_id", F.lit("P1"))
    several = links("M1", "M2", "M1")
    for fanned in (["member"], None):
        got = core.resolve_roles(claims, wh.stg("stg_clline"), several, fanned=fanned).select("member.key", F.col("billing.key").alias("b"), "servicing")
        assert sorted(r.key for r in got.collect()) == ["k0", "k2"] and {(r.b, r.servicing) for r in got.collect()} == {("p", None)}
    joins = [core.resolve_roles(claims, wh.stg("stg_clline"), several, fanned=f)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for f in ([], ["member"], None)]
    assert joins[0] < joins[1] < joins[2]


def test_what_a_wide_lookup_finds_meets_the_header_in_one_shuffle(spark, wh, monkeypatch):
    from carespark.plans import core
    from carespark.plans.warehouse import Warehouse

    before = wh.fct_claim
    monkeypatch.setattr(core, "WIDE_LINKS", 1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = Warehouse.from_driver(spark, wh.raw.sf_dir).fct_claim
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "row#" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning(claim_id" in x)  # gathered where it meets the header
        assert wide.exceptAll(before).count() == before.exceptAll(wide).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
