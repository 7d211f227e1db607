"""No row is lost: NULL keys, stale load months, missing change times, uncut inputs, skewed roles."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from carespark.operators import scd2, upsert
from carespark.plans import core, marts, scenarios
from carespark.sources.adapter import RawSource, input_files
from conftest import SF_SMALL

T0 = dt.datetime(2001, 1, 1)
RUNS = [dt.datetime(2001, m, 1) for m in (2, 3, 4)]


def test_null_key_survives_snapshot_runs(spark):
    src = spark.createDataFrame([("a", "x", T0), (None, "y", T0)], "k string, v string, at timestamp_ntz")
    history = None
    for run in RUNS:
        history = scd2.snapshot_merge(history, src, "k", "at", run)
    rows = history.collect()
    assert sorted((r.k or "", r.dbt_valid_to) for r in rows) == [("", None), ("a", None)]


def test_latest_keeps_every_null_key(spark):
    src = spark.createDataFrame([(None, 1, T0), (None, 2, T0), ("a", 3, T0), ("a", 4, RUNS[0])], "k string, v int, _loaded_at timestamp_ntz")
    got = upsert.dedupe_batch(src, "k", "latest").collect()
    assert sorted((r.k or "", r.v) for r in got) == [("", 1), ("", 2), ("a", 4)]


def test_load_month_is_recomputed_and_a_stale_one_rejected(spark):
    src = spark.createDataFrame([("a", dt.datetime(2024, 1, 20), dt.date(2024, 1, 1))], "k string, _loaded_at timestamp_ntz, load_month date")
    moved = src.withColumn("_loaded_at", F.col("_loaded_at") + F.expr("interval 20 days"))
    wm = dt.datetime(2024, 2, 5)
    assert upsert.after_watermark(upsert.reload_month(moved), wm).count() == 1
    with pytest.raises(Exception, match="stale load month"):
        upsert.checked_month(moved).collect()
    assert upsert.checked_month(src).count() == 1


def test_members_without_change_time_are_in_the_change_log(spark, wh):
    staged = wh.stg("stg_member")
    ids = lambda df: {r.member_id for r in df.select("member_id").distinct().collect()}
    assert ids(scenarios.snapshot_changes(staged)) == ids(scenarios.snapshot_history(staged, "member"))


def test_raw_extracts_are_not_cut(spark, wh):
    count = lambda t: duckdb.sql(f"select count(*) from read_parquet('{SF_SMALL}/{t}.parquet')").fetchall()[0][0]
    for raw, table in (("clclaim", "orders"), ("clline", "lineitem"), ("cldiag", "lineitem"), ("clproc", "lineitem"),
                       ("cladjust", "events"), ("diagcode", "part"), ("provider", "supplier"), ("member", "customer")):
        assert wh.raw[raw].count() == count(table), raw


def test_inputs_are_fingerprinted_through_spark(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    before = input_files(spark, f"file:{path}")
    assert before and before == input_files(spark, path) and all(size > 0 for _, size, _ in before)
    spark.range(4).write.mode("overwrite").parquet(path)
    assert input_files(spark, f"file:{path}") != before


def test_one_load_time_spreads_over_partitions(spark):
    raw = RawSource(spark, SF_SMALL)
    df = raw.derived("cldiag").withColumn("_loaded_at", F.lit(T0).cast("timestamp_ntz"))
    dealt = df.repartitionByRange(4, "_loaded_at", F.xxhash64("claimid"))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)


def test_optional_roles_and_fan_out(spark, wh):
    """Nine in ten referring ids are NULL, and one provider has two active links."""
    claims = wh.stg("stg_clclaim").withColumn(
        "referring_provider_id", F.when(F.crc32(F.encode("claim_id", "UTF-8")) % 10 == 0, F.col("referring_provider_id")))
    links = wh.stg("stg_provider_crosswalk")
    twice = links.unionByName(links.where("source_system = 'QNXT' and is_active").limit(1).withColumn("crosswalk_id", F.lit("again")))
    args = [claims, wh.stg("stg_clline"), wh.stg("stg_member_crosswalk")]
    rest = [wh.dim_golden_member, wh.dim_golden_provider, wh.dim_member, wh.dim_provider]
    once, fanned = (core.fct_claim_conformed(*args, xw, *rest).cache() for xw in (links, twice))
    hit = twice.where("crosswalk_id = 'again'").first()
    roles = [f"source_{r}_provider_id" for r in ("billing", "servicing", "referring")]
    extra = sum(2 ** sum(r[c] == hit.source_provider_id for c in roles) - 1 for r in once.select(*roles).collect())
    assert fanned.count() - once.count() == extra > 0
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "referring_provider_id" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_prorated_start(spark):
    elig = spark.createDataFrame([("m", "e", dt.date(2001, 1, 16), dt.date(2001, 2, 14))], "member_id string, eligibility_id string, effective_date date, termination_date date")
    for c in ("lob_id", "line_of_business", "plan_id", "plan_name", "product_id", "group_id", "subgroup_id", "coverage_type", "relationship_code", "pcp_provider_id"):
        elig = elig.withColumn(c, F.lit(None).cast("string"))
    months = lambda **o: {r.calendar_month.month: r.member_month_units / marts.MONTH_LCM for r in marts.member_month_detail(elig, dt.date(2001, 6, 30), **o).collect()}
    assert months() == {2: 14 / 28}
    assert months(prorate_start=True) == {1: 16 / 31, 2: 14 / 28}


def largest_and_median(df):
    """Rows of the fullest task, and of the median task that has rows."""
    sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    return sizes[-1], sizes[len(sizes) // 2]


def test_busy_and_wide_ids_are_split(spark):
    """One provider on half the claims, and an id with 100,000 links."""
    from carespark.operators import skew

    n = 120_000
    ids = spark.range(n).select(F.col("id").alias("claim_id"), F.lit("provider").alias("kind"),
                                F.when(F.col("id") % 2 == 0, F.lit("busy")).otherwise(F.concat(F.lit("p"), (F.col("id") % 7919).cast("string"))).alias("id"))
    links = spark.range(8000).select(F.lit("provider").alias("kind"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("id"), F.col("id").cast("string").alias("link"))
    wide = spark.range(100_000).select(F.lit("provider").alias("kind"), F.lit("p5").alias("id"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("link"))
    links = links.unionByName(spark.createDataFrame([("provider", "busy", "b")], "kind string, id string, link string")).unionByName(wide)
    key = ["kind", "id"]
    busy, heavy_links = skew.heavy_keys(ids, key), skew.heavy_keys(links, key)
    assert [b[:2] for b in busy] == [("provider", "busy")] and [b[:2] for b in heavy_links] == [("provider", "p5")]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plain, split = ids.join(links, key), skew.split_join(ids, links, key, busy, heavy_links)
        assert split.count() == plain.count() and split.select(*plain.columns).exceptAll(plain).count() == 0
        most, median = largest_and_median(split)
        assert most < 3 * median < largest_and_median(plain)[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_fact_joins_on_stored_buckets_without_an_exchange(spark, wh):
    """Neither the header nor the lines are shuffled by claim_id."""
    import re

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        header, lines = wh.by_claim("stg_clclaim"), wh.by_claim("stg_clline")
        plan = header.join(core.line_rollup(lines), "claim_id", "left")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        fact = core.fct_claim(header, lines, wh.dim_member, wh.dim_provider)._jdf.queryExecution().executedPlan().toString()
        # The narrow resolved ids are the only side that is dealt by claim; the wide header and the lines stay where they lie.
        dealt = [line for line in fact.splitlines() if re.search(r"Exchange hashpartitioning\(claim_id", line)]
        assert dealt and not any("billed" in line for line in dealt)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_claims_that_share_an_id_keep_their_own_roles(spark, wh):
    """Two header rows of one claim_id with other providers."""
    claims = wh.stg("stg_clclaim")
    one = claims.where("billing_provider_id is not null and servicing_provider_id is not null").limit(1)
    other = one.withColumn("billing_provider_id", F.lit("nobody")).withColumn("member_id", F.lit(None).cast("string"))
    both = one.unionByName(other)
    got = core.fct_claim(both, wh.stg("stg_clline"), wh.dim_member, wh.dim_provider).collect()
    assert len(got) == 2
    mine, theirs = sorted(got, key=lambda r: r.member_id is None)
    assert theirs.member_key is None and theirs.billing_provider_key is None and mine.servicing_provider_key == theirs.servicing_provider_key
